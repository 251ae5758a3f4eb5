"""N-gram Jaccard join: rare-first prefix filtering, then one verification a pair.

Two texts link when their sets of distinct five-word shingles overlap by three quarters of their union.
The steps, all over whole texts:

1. Every text gets a content key (a hash of its words) and its number of shingles. Copies share the
   key; from here on a content stands for all its copies.
2. Shingle hashes are packed by bucket and shuffled; a bucket finds those that several contents
   have, with their frequency. A shingle that one content alone has takes part in no link.
3. Per content, its shared shingles are put in order, rare ones first (its own count as the rarest).
   The prefix is what remains when three quarters are taken off; two linked contents share a prefix
   shingle. Contents whose prefix holds none but their own shingles are done.
4. Contents that share a prefix shingle are candidates. Since components are asked for, most pairs are
   spared: first each content is verified against one content of each of its prefix shingles; then
   the pairs whose contents are in different components still are joined in full, the smaller one of a pair on
   its shorter prefix, under the length, the positional and the suffix filter (a bitmap that bounds the difference
   of two sets), and none is lost.
5. Every pair left is verified once, by intersecting the shared shingles.

A text of fewer than five words has one shingle, its whole sequence; a text without words (or a null)
has none and links with nothing. Repeated rows and ids are separate rows of one content. A very long text is a piece of
its own: its shingles go out by bucket like all others, and only those it shares come back as one row. Shingles are
told apart by at least 54 bits and contents by 62 bits of hashes that are mixed from eight bytes at a time and rolled
modulo two primes; all counts are exact apart from that.

A hot shingle is one entry a content and a bucket, so it lies spread over as many rows as there
are map tasks; a group of copies is one content; a group of near copies costs a star
and the pairs of its outliers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprintmart.llm.components import components
from sprintmart.llm.flat import LOWER, SPACE, Rolling, flat_texts, joined, mix, pieces, runs, span_hashes
from sprintmart.llm.kept import claim, keeper, release
from sprintmart.llm.stored import stored

WORDS = 5
#: Jaccard threshold as a fraction.
NUM, DEN = 3, 4

#: Shingles of a bucket, and bytes of text whose shingles are packed together.
BUCKET_GRAMS = 1_000_000
MIN_BUCKETS = 64
PACK_BYTES = 8 << 20

_WORDS = Rolling(0xC2B2AE3D27D4EB4F)
keeper("ngram_join", _WORDS.forget)
_LOW = np.uint64((1 << 48) - 1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of flat texts: hashes and their text, in order of the text; then content key
    and number of words of each text."""
    n = len(offsets) - 1
    start, end = runs(~SPACE[data], offsets)
    owner = np.searchsorted(offsets, start, "right") - 1
    n_words = np.bincount(owner, minlength=n)
    sums = _WORDS.sums(span_hashes(LOWER[data], start, end))
    last = np.cumsum(n_words)
    key = _WORDS.spans(sums, last - n_words, last)
    first = np.arange(max(0, len(start) - WORDS + 1))
    first = first[owner[first] == owner[first + WORDS - 1]] if len(first) else first
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    grams = np.concatenate((_WORDS.spans(sums, first, first + WORDS), key[short]))
    of = np.concatenate((owner[first], short))
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return grams[new], of[new], key, n_words


def profile(text: Column) -> Column:
    """A struct of a text's content key (null without words) and its number of distinct shingles."""

    @F.arrow_udf("struct<key:bigint,n_shingles:bigint>")
    def profiles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        claim("ngram_join")
        for column in batches:
            data, offsets = flat_texts(column)
            for a, b in pieces(offsets):
                _, of, key, n_words = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sizes = np.bincount(of, minlength=b - a)
                yield pa.StructArray.from_arrays(
                    [pa.array(key.view(np.int64), mask=n_words == 0), pa.array(sizes)], ["key", "n_shingles"]
                )

    return profiles(text)


_PACKED = "bucket int, grams binary, keys binary, sizes binary, counts binary"
_PACKED_FIELDS = pa.schema(
    [("bucket", pa.int32()), *((c, pa.binary()) for c in ("grams", "keys", "sizes", "counts"))]
)


def _packed_rows(grams: np.ndarray, keys: np.ndarray, sizes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Shingles by bucket; runs of one content are stored once with their length."""
    bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, grams, keys, sizes = bucket[order], grams[order], keys[order], sizes[order]
    low = np.ascontiguousarray((grams & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    head = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (keys[1:] != keys[:-1])))
    at = np.flatnonzero(head)
    counts = np.diff(np.append(at, len(grams))).astype("<u4")
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    run_cuts = np.searchsorted(at, cuts)
    rows = []
    for i in range(len(cuts) - 1):
        r = slice(run_cuts[i], run_cuts[i + 1])
        rows.append(
            (int(bucket[cuts[i]]), low[cuts[i] : cuts[i + 1]].tobytes(), keys[at[r]].astype("<i8").tobytes(),
             sizes[at[r]].astype("<u4").tobytes(), counts[r].tobytes())
        )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKED_FIELDS, strict=True)],
        schema=_PACKED_FIELDS,
    )


def pack_shingles(texts: DataFrame, buckets: int) -> DataFrame:
    """All shingles of a column of texts by bucket, a row for each bucket and ``PACK_BYTES`` of text."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join")
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            data, offsets = flat_texts(batch.column(0))
            for a, b in pieces(offsets):
                grams, of, key, n_words = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sizes = np.bincount(of, minlength=b - a)
                # Copies within a piece would only be told apart later.
                once = np.zeros(b - a, bool)
                once[np.unique(key, return_index=True)[1]] = True
                keep = once[of]
                held.append((grams[keep], key.view(np.int64)[of[keep]], sizes[of[keep]]))
                size += int(offsets[b] - offsets[a])
                if size >= PACK_BYTES:
                    yield from _close(held, buckets)
                    held, size = [], 0
        yield from _close(held, buckets)
        held.clear()
        release()

    return texts.mapInArrow(packs, _PACKED)


def _close(held: list, buckets: int) -> Iterator[pa.RecordBatch]:
    if held and sum(len(h[0]) for h in held):
        yield _packed_rows(*(np.concatenate(c) for c in zip(*held, strict=True)), buckets)


_SHARED = "part int, keys binary, sizes binary, grams binary, freqs binary"
_SHARED_FIELDS = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("keys", "sizes", "grams", "freqs"))])


def _shared_of_bucket(parts: int):
    """Finds the shingles of a bucket that several contents have, and deals them out by content."""

    def find(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        release()
        raw = joined(table, "grams", np.uint8).reshape(-1, 6)
        gram = np.zeros((len(raw), 8), np.uint8)
        gram[:, :6] = raw
        gram = gram.view("<u8").ravel() | np.uint64(key[0].as_py() % 65536 << 48)
        counts = joined(table, "counts", "<u4")
        owner = np.repeat(joined(table, "keys", "<i8"), counts)
        size = np.repeat(joined(table, "sizes", "<u4"), counts)
        order = np.lexsort((owner, gram))
        gram, owner, size = gram[order], owner[order], size[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner, size = gram[new], owner[new], size[new]
        first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        freq = np.diff(np.append(first, len(gram)))
        freq = np.repeat(freq, freq)
        several = freq > 1
        gram, owner, size, freq = gram[several], owner[several], size[several], freq[several]
        part = (owner.view(np.uint64) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((owner, part))
        gram, owner, size, freq, part = (c[order] for c in (gram, owner, size, freq, part))
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else [0]
        rows = [
            (int(part[a]), owner[a:b].astype("<i8").tobytes(), size[a:b].astype("<u4").tobytes(),
             gram[a:b].astype("<u8").tobytes(), np.minimum(freq[a:b], 2**32 - 1).astype("<u4").tobytes())
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(columns, _SHARED_FIELDS, strict=True)], schema=_SHARED_FIELDS
        )

    return find


_RECORD = "key bigint, n bigint, own bigint, n_prefix bigint, grams binary, bits array<bigint>"
_RECORD_FIELDS = pa.schema(
    [("key", pa.int64()), ("n", pa.int64()), ("own", pa.int64()), ("n_prefix", pa.int64()), ("grams", pa.binary()),
     ("bits", pa.list_(pa.int64()))]
)

#: Length of the parity bitmap of a content's shared shingles, in bits.
BITMAP = 512


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """One bit a range of the hash: whether an odd number of shingles falls there. Two bitmaps differ in no more
    places than their sets do."""
    odd = np.bincount((mix(grams) % np.uint64(BITMAP)).astype(np.int64), minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _records_of_part(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Contents whose prefix holds shared shingles, with all their shared shingles, rare ones first."""
    release()
    owner, size = joined(table, "keys", "<i8"), joined(table, "sizes", "<u4").astype(np.int64)
    gram, freq = joined(table, "grams", "<u8"), joined(table, "freqs", "<u4")
    order = np.lexsort((gram, freq, owner))
    owner, size, gram = owner[order], size[order], gram[order]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    m = np.diff(np.append(first, len(owner)))
    n = size[first]
    # Without the prefix, fewer than the overlap that a link needs would be left.
    n_prefix = n - -(-NUM * n // DEN) + 1 - (n - m)
    rows = [
        (int(owner[a]), int(s), int(s - c), int(min(p, c)), gram[a : a + c].astype("<u8").tobytes(),
         parity_bits(gram[a : a + c]))
        for a, s, c, p in zip(first, n, m, n_prefix, strict=True)
        if p > 0
    ]
    columns = list(zip(*rows, strict=True)) or [()] * len(_RECORD_FIELDS)
    return pa.table(
        [pa.array(c, f.type) for c, f in zip(columns, _RECORD_FIELDS, strict=True)], schema=_RECORD_FIELDS
    )


def prefix_entries(records: DataFrame) -> DataFrame:
    """(gram, key, n, own, pos) of the shared shingles in each prefix; ``pos`` counts the content's own too."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            columns = (batch.column(c) for c in ("key", "n", "own", "n_prefix", "grams"))
            for key, n, own, p, grams in zip(*(c.to_pylist() for c in columns), strict=True):
                gram = np.frombuffer(grams, "<i8", count=p)
                parts.append((gram, np.full(p, key), np.full(p, n), np.full(p, own), own + np.arange(p)))
            if parts:
                arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["gram", "key", "n", "own", "pos"])

    return records.drop("bits").mapInArrow(entries, "gram bigint, key bigint, n bigint, own bigint, pos bigint")


def verified(a_grams: Column, b_grams: Column, a_n: Column, b_n: Column) -> Column:
    """Whether two contents link, from their shared shingles and their numbers of all shingles."""

    @F.arrow_udf("boolean")
    def links(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for x, y, xn, yn in batches:
            out = []
            for g, h, n, k in zip(x, y, xn.to_numpy(), yn.to_numpy(), strict=True):
                out.append(link(np.frombuffer(g.as_py(), "<u8"), np.frombuffer(h.as_py(), "<u8"), int(n), int(k)))
            yield pa.array(out, pa.bool_())

    return links(a_grams, b_grams, a_n, b_n)


def link(x: np.ndarray, y: np.ndarray, n: int, k: int) -> bool:
    """Exact test on two sets of shared shingles; ``n`` and ``k`` are the sizes of the whole sets."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * common >= NUM * (n + k - common)


def verify(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. The side with hot contents is joined first, while rows are narrow."""
    side = records.select("key", "n", "grams")
    with_a = pairs.select("a", "b").join(side.toDF("a", "a_n", "a_grams"), "a")
    both = with_a.join(side.toDF("b", "b_n", "b_grams"), "b")
    test = verified(F.col("a_grams"), F.col("b_grams"), F.col("a_n"), F.col("b_n"))
    return both.select("a", "b", test.alias("links")).where("links").select("a", "b")


def _may_link(x: str, y: str) -> Column:
    """Length filter, and enough shared shingles on both sides, for contents with sizes n and own parts."""
    n, k = F.col(f"{x}.n"), F.col(f"{y}.n")
    shared = F.least(n - F.col(f"{x}.own"), k - F.col(f"{y}.own"))
    return (n * DEN >= k * NUM) & (k * DEN >= n * NUM) & (shared * (NUM + DEN) >= (n + k) * NUM)


def _before(x: str, y: str) -> Column:
    """The smaller content of a pair, by size and key."""
    n, k = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (n < k) | ((n == k) & (F.col(f"{x}.key") < F.col(f"{y}.key")))


def _indexed(x: str) -> Column:
    """Whether a prefix shingle is in the shorter prefix that a content needs towards larger ones: it overlaps
    with them by 6/7 of its own size at least (2t/(1+t) of the threshold t)."""
    n = F.col(f"{x}.n")
    return F.col(f"{x}.pos") <= n - F.ceil(n * (2 * NUM) / (NUM + DEN))


def _position_fits(x: str, y: str) -> Column:
    """Positional filter: what can be common up to this shingle (own ones aside) and behind it suffices."""
    side = lambda s: (F.col(f"{s}.pos") - F.col(f"{s}.own"), F.col(f"{s}.n") - F.col(f"{s}.pos") - 1)
    (a, c), (b, d) = side(x), side(y)
    most = F.least(a, b) + 1 + F.least(c, d)
    return most * (NUM + DEN) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * NUM


def _suffix_fits(x: str, y: str) -> Column:
    """Suffix filter: own shingles and the places where the bitmaps differ are differences; a link has few."""
    differ = F.aggregate(
        F.zip_with(f"{x}.bits", f"{y}.bits", lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("int")),
        F.lit(0), lambda s, v: s + v,
    )
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    # With an overlap of 3/7 of both sizes together, 1/7 of them differs at most.
    return (F.col(f"{x}.own") + F.col(f"{y}.own") + differ) * (NUM + DEN) <= total * (DEN - NUM)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(f"{x}.key", f"{y}.key").alias("a"), F.greatest(f"{x}.key", f"{y}.key").alias("b")]


def star_pairs(entries: DataFrame) -> DataFrame:
    """Each content of a shingle with that one of it which has the smallest part of its own; in a group of near
    copies that is close to the original, and most others link with it."""
    clean = F.struct((F.col("own") / F.col("n")).alias("part"), "key")
    centre = entries.groupBy("gram").agg(F.min_by(F.struct("key", "n", "own"), clean).alias("c"))
    met = entries.alias("x").join(centre.select("gram", "c.*").alias("c"), "gram")
    return met.where((F.col("x.key") != F.col("c.key")) & _may_link("x", "c")).select(*_pair("x", "c")).distinct()


def remaining_pairs(entries: DataFrame, records: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of contents that share a shingle of their prefixes, lie in different components so far, and pass
    the filters. Of each shingle, the largest component meets only the rest."""
    labelled = entries.join(members, "key", "left").withColumn("label", F.coalesce("component", "key"))
    sizes = labelled.groupBy("gram", "label").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("gram").agg(F.max_by("label", F.struct("c", "label")).alias("major"), F.count("*").alias("k"))
    tagged = labelled.join(mixed.where("k > 1").drop("k"), "gram").drop("component")
    tagged = stored(tagged.join(records.select("key", "bits"), "key"), "open")
    # The smaller content of a pair meets the larger one on its indexed shingles alone, so these are picked
    # before the join; a pair of two contents outside the major component is met in one of the two joins.
    small = _indexed("x")
    fits = _before("x", "y") & (F.col("x.label") != F.col("y.label")) & _may_link("x", "y")
    fits = (F.col("x.gram") == F.col("y.gram")) & fits & _position_fits("x", "y") & _suffix_fits("x", "y")
    minor, major = "label <> major", "label = major"
    met = [
        tagged.where(one).alias("x").where(small).join(tagged.where(other).alias("y"), fits).select(*_pair("x", "y"))
        for one, other in ((minor, "true"), (major, minor))
    ]
    return met[0].unionByName(met[1]).distinct()


def linked_contents(texts: DataFrame, n_shingles: int) -> DataFrame:
    """(key, component) of all contents that link with another one. ``texts`` has one column of texts
    with ``n_shingles`` shingles in all, which sets the number of buckets."""
    buckets = max(MIN_BUCKETS, -(-n_shingles // BUCKET_GRAMS))
    shared = pack_shingles(texts, buckets).groupBy("bucket").applyInArrow(_shared_of_bucket(buckets), _SHARED)
    records = stored(shared.groupBy("part").applyInArrow(_records_of_part, _RECORD), "records")
    entries = stored(prefix_entries(records), "entries")
    stars = stored(verify(star_pairs(entries), records), "links")
    members = components(stars.toDF("u", "v")).toDF("key", "component")
    rest = stored(verify(remaining_pairs(entries, records, members), records), "links")
    return components(stars.unionByName(rest).toDF("u", "v")).toDF("key", "component")


def row_key(doc_id: str, text: str) -> Column:
    """128 bits of a row's id and text; a null differs from any value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (doc_id, text)]
    return F.md5(F.concat(parts[0], F.lit("\n"), parts[1]))


def near_duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles``, its content ``key`` (null without words), :func:`row_key`
    , the content that names its ``group`` (null without words), and ``component_id``, the smallest id
    reachable by links (its own for a text without words; null if no id of a component is known)."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), profile(F.col(text)).alias("p"), row_key(doc_id, text).alias("row_key")
    )
    rows = stored(rows.select("doc_id", "p.key", "p.n_shingles", "row_key"), "profiles")
    n_shingles = rows.agg(F.sum("n_shingles")).first()[0] or 0
    linked = stored(linked_contents(docs.select(text), n_shingles), "linked")
    contents = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    grouped = contents.join(linked, "key", "left")
    least = grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("far"))
    named = grouped.join(least, "component", "left").select(
        "key", F.coalesce("component", "key").alias("group"), F.coalesce("far", "least").alias("component_id")
    )
    found = rows.join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "key", "row_key", "group", own.alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id, nulls last. Texts without words are in
    no group and all stay. Of rows equal in id and text one stays."""
    groups = near_duplicate_groups(docs, doc_id, text)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    chosen = (
        groups.where("group IS NOT NULL").groupBy("group").agg(F.min_by("row_key", order).alias("_row"))
        .select("_row", F.lit(True).alias("_grouped"))
    )
    apart = groups.where("group IS NULL").select(F.col("row_key").alias("_row"), F.lit(False).alias("_grouped"))
    kept = stored(chosen.unionByName(apart).distinct(), "kept")
    held = docs.select(F.struct(*docs.columns).alias("_doc"), row_key(doc_id, text).alias("_row")).join(kept, "_row")
    turn = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    return held.withColumn("_turn", turn).where("_turn = 1 OR NOT _grouped").select("_doc.*")
