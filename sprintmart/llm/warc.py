"""WARC archives whose records share an embedded Zstandard dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a dictionary built from
the archive's own records; every record follows as a frame of its own, so a reader needs no other
file and can decompress any single record. Archives are rows of a table (name, content), each content
being a complete ``.warc.zst`` file, because every store that Spark writes to takes a table;
:func:`save_files` writes them as files into a folder that the driver sees.

Payloads of at least ``MIN_REVISIT`` bytes that occur under several page ids are stored once: the
record with the smallest id is the response, the others are revisit records that name it. Repeated
rows of that id are all responses. A null payload is empty; a null id is stored as one without an id,
and it never becomes the one that others refer to. Equality is that of SHA-256 digests.

Shuffles: digests are counted with pre-aggregation, and pages meet only the digests that occur
more than once in a plain join, whose hot partitions adaptive execution splits. Memory: one
archive of ``ARCHIVE_BYTES`` and its dictionary sample of ``SAMPLE_BYTES``, or one longer record.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 256 << 10
DICT_BYTES = 32 << 10
LEVEL = 3

#: Fixed value: the magic number of the frame that holds a dictionary.
DICT_MAGIC = 0x184D2A5D
_ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_SCHEMA = "archive string, content binary, n_records bigint"
RECORD_SCHEMA = (
    "page_id bigint, target_uri string, record_type string, refers_to bigint, payload binary,"
    " payload_bytes bigint, payload_digest string"
)
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as (page_id, url, payload, digest, refers_to); ``refers_to`` is null for responses."""
    payload: Column = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT)
    shared = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    repeats = ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(repeats, F.col("first")).alias("refers_to")
    )


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest}'.encode()).digest())}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record, uncompressed."""
    revisit = refers_to is not None
    size = len(payload)
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if not revisit:
        body += payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to),
        ("X-Payload-Length", size),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(body)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """The fields of ``RECORD_SCHEMA``; a length or digest that doesn't fit is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit")
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    payload = None
    if fields["WARC-Type"] == "response":
        payload = body.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload does not fit its digest")
    uri = fields.get("WARC-Target-URI")
    if uri is not None:
        uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("X-Page-ID"), uri, fields["WARC-Type"], number("X-Refers-To-Page-ID"), payload, size, digest


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from an even sample of the records, of ``SAMPLE_BYTES`` at most; where they are too
    few to train on, the sample itself is the dictionary."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample, size = [], 0
    for data in records[::step]:
        sample.append(data[: SAMPLE_BYTES - size])
        size += len(sample[-1])
        if size >= SAMPLE_BYTES:
            break
    if len(sample) >= 8 and size > 8 * 1024:
        try:
            return zstandard.train_dictionary(min(DICT_BYTES, size // 4), sample, k=256, d=8, level=LEVEL)
        except zstandard.ZstdError:
            pass  # too little that repeats
    return zstandard.ZstdCompressionDict(b"".join(sample)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack(records: list[bytes]) -> bytes:
    """A complete archive."""
    dictionary = build_dictionary(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    data = dictionary.as_bytes()
    return struct.pack("<II", DICT_MAGIC, len(data)) + data + b"".join(map(compressor.compress, records))


def _frame_end(data: memoryview, at: int) -> int:
    """End of the Zstandard frame that starts at ``at``."""
    header = zstandard.frame_header_size(data[at : at + 18])
    checked = zstandard.get_frame_parameters(data[at : at + 18]).has_checksum
    at += header
    while True:
        block = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        at += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * checked


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, in order."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICT_MAGIC:
        raise ValueError("the archive has no dictionary frame")
    data = memoryview(archive)
    raw = archive[8 : 8 + size]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at = 8 + size
    while at < len(data):
        end = _frame_end(data, at)
        yield reader.decompress(data[at:end])
        at = end


def write_archives(records: DataFrame, date: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of the records from :func:`plan_records`, as rows of ``ARCHIVE_SCHEMA``. ``date`` is the
    date that all records bear, as ``2024-01-31T00:00:00Z``."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = count = 0

        def close() -> pa.RecordBatch:
            nonlocal size, count
            row = [[f"{part:06d}-{count:05d}.warc.zst"], [pack(held)], [len(held)]]
            held.clear()
            size, count = 0, count + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0]), pa.array(row[1], pa.binary()), pa.array(row[2], pa.int64())],
                ["archive", "content", "n_records"],
            )

        for batch in batches:
            columns = (batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to"))
            for fields in zip(*columns, strict=True):
                held.append(record(*(f.as_py() for f in fields), date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    return records.mapInArrow(archives, ARCHIVE_SCHEMA)


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of a table of archives, as ``RECORD_SCHEMA``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for data in unpack(content.as_py()):
                    rows.append(parse_record(data))
                    size += len(data)
                    if size >= 4 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    return archives.select("content").mapInArrow(records, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_RECORDS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)], schema=_RECORDS
    )


def save_files(archives: DataFrame, folder: str) -> int:
    """Write each archive as a file into a folder that the driver sees, one at a time."""
    target = Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    count = 0
    for row in archives.toLocalIterator():
        (target / row["archive"]).write_bytes(row["content"])
        count += 1
    return count
