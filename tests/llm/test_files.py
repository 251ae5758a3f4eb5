"""Archives, shards, the pipeline, and the registered queries."""

from __future__ import annotations

import hashlib
import os
import random
import struct

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sprintmart.llm import decontaminate, queries, sharding, warc
from tests.llm.conftest import ODD
from tests.llm.test_pairs import plain_components
from tests.llm.test_text_rules import plain_hits

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DATE = "2024-01-01T00:00:00Z"


@pytest.fixture
def pages(spark, prose):
    long = prose(1, 80)
    html = [long, "x" * 99, "x" * 99, long, None, "", long, prose(2, 60), "<p>é漢</p>" * 30, "<p>é漢</p>" * 30, "y" * 300_000]
    rows = [(i, f"http://h/{i}?a=%20\r\nb" if i % 2 else None, t) for i, t in enumerate(html)]
    rows += [(None, "u", long), (0, "again", long)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archives_give_back_what_was_written(spark, pages, tmp_path):
    planned = warc.plan_records(pages)
    archives = warc.write_archives(planned, DATE, archive_bytes=2_000)
    archives.write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    got = warc.read_archives(stored).collect()
    source = {(r.page_id, r.url, r.html or "") for r in pages.collect()}
    responses = {(r.page_id, r.target_uri, bytes(r.payload).decode()) for r in got if r.record_type == "response"}
    assert responses <= source
    assert len(got) == pages.count()
    first = hashlib.sha256(pages.first().html.encode()).hexdigest()
    revisits = sorted((r.page_id is None, r.page_id, r.refers_to) for r in got if r.record_type == "revisit")
    assert revisits == [(False, 3, 0), (False, 6, 0), (False, 9, 8), (True, None, 0)]
    assert {r.payload_digest for r in got if r.refers_to == 0} == {first}
    assert all(r.payload_bytes == len(r.payload) for r in got if r.payload is not None)


def test_archives_are_plain_zstandard_files(pages, tmp_path):
    archives = warc.write_archives(warc.plan_records(pages), DATE)
    count = warc.save_files(archives, str(tmp_path / "files"))
    files = sorted((tmp_path / "files").iterdir())
    assert len(files) == count and files[0].name.endswith(".warc.zst")
    for path in files:
        data = path.read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        own = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=own).stream_reader(data, read_across_frames=True)
        whole = reader.read()
        assert whole.startswith(b"WARC/1.1\r\n") and whole == b"".join(warc.unpack(data))


def test_a_damaged_archive_is_an_error(prose):
    data = warc.pack([warc.record(1, "u", prose(3, 50).encode(), "0" * 64, None, DATE)])
    with pytest.raises(ValueError, match="digest"):
        [warc.parse_record(r) for r in warc.unpack(data)]
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.unpack(b"\0" * 64))


def test_the_dictionary_saves_bytes(prose):
    records = [warc.record(i, f"http://h/{i}", prose(i, 40).encode(), "0" * 64, None, DATE) for i in range(400)]
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(warc.pack(records)) < 0.8 * alone
    assert list(warc.unpack(warc.pack(records[:1]))) == records[:1]


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(warc.plan_records(none), DATE)).count() == 0


def placed(spark, docs, tmp_path, shards=16):
    records = docs.select("doc_id", sharding.text_size("text").alias("size"), sharding.text_crc32("text").alias("c"))
    records = records.withColumn("vslot", sharding.virtual_slot(["doc_id", "size", "c"]))
    totals = sharding.slot_totals(records)
    owner = sharding.rebalance(sharding.first_map(sharding.SLOTS, shards), totals, shards)
    path = str(tmp_path / "map")
    sharding.store_map(spark, path, sharding.map_rows(1, sharding.first_map(sharding.SLOTS, shards), totals))
    sharding.store_map(spark, path, sharding.map_rows(2, owner, totals))
    return sharding.place(records, sharding.latest_map(spark, path), ["doc_id", "size", "c"])


def test_shards_are_even_and_slots_gapless(spark, docs_of, tmp_path):
    rng = random.Random(1)
    docs = docs_of(["z" * rng.randint(0, 900) for _ in range(3000)] + [None, ""])
    rows = placed(spark, docs.union(docs.where("doc_id < 5")), tmp_path).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    sizes = [sum(r["size"] for r in own) for own in by.values()]
    assert len(rows) == 3007 and len(by) == 16 and max(sizes) - min(sizes) <= 20
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())


def test_rebalancing_moves_little_and_settles():
    rng = random.Random(2)
    totals = {s: (rng.randint(0, 1000), 1) for s in range(sharding.SLOTS)}
    before = sharding.first_map(sharding.SLOTS, 16)
    after = sharding.rebalance(before, totals, 16)
    assert sum(before[s] != after[s] for s in before) < 0.05 * sharding.SLOTS
    assert sharding.rebalance(after, totals, 16) == after
    hot = dict.fromkeys(range(64), (0, 0)) | {3: (10**6, 9)}
    assert sharding.rebalance(sharding.first_map(64, 4), hot, 4)[3] in range(4)


def test_sharding_an_empty_table(spark, docs_of, tmp_path):
    assert placed(spark, docs_of([]), tmp_path).count() == 0


@pytest.fixture
def corpus(spark, words, prose, tmp_path):
    """A folder of tables with everything the stages look for."""
    rng = random.Random(9)
    texts, toxic = [], {}
    for i in range(240):
        own = prose(5000 + i, rng.randint(60, 140)).split(" ")
        if i % 4 == 0:
            own = [rng.choice(["blorgface", "wugsnort", "zibblehead"]) if k % 12 == 3 else w for k, w in enumerate(own)]
        texts.append(" ".join(own))
        toxic[i] = int(i % 4 == 0)
    passage, test = prose(6000, 70), prose(6001, 30)
    for i in range(20):
        texts.append(f"{prose(7000 + i, 40)}\n{passage}\n{prose(7100 + i, 40)}")
    near = prose(6002, 48)
    texts += [near, near + " tail", near.upper()]
    texts += [f"{prose(7200 + i, 20)} {test}" for i in range(3)]
    texts += [t for t in ODD if t is None or len(t) < 20_000]
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    marks = [(i, 1 - v if v else 0, v) for i, v in toxic.items()]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, test)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), passage, test


def test_each_stage_on_its_own_input(spark, corpus, tmp_path):
    folder, passage, test = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / f"out{k}"))
        seen[name] = docs, spark.read.parquet(str(tmp_path / f"out{k}"))
        docs = seen[name][1]
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    before, after = seen["toxicity"]
    gone = ids(before) - ids(after)
    assert len(gone & {i for i in range(240) if i % 4 == 0}) >= 55
    assert len(gone - {i for i in range(240) if i % 4 == 0}) <= 4
    before, after = seen["line dedup"]
    flat = lambda t: " ".join((t or "").split())
    assert sum(flat(passage) in flat(r.text) for r in after.collect()) == 1
    assert all(r.n_chars == len(r.text or "") for r in after.collect())
    before, after = seen["n-gram Jaccard join"]
    expected = plain_components({r.doc_id: r.text for r in before.collect()})
    assert ids(after) == {i for i, (_, c) in expected.items() if i == c}
    before, after = seen["benchmark decontamination"]
    dirty = set()
    for r in before.collect():
        n, hit, _ = plain_hits(r.text, [(1, test)])
        if hit and 20 * hit >= n:
            dirty.add(r.doc_id)
    assert dirty and ids(after) == ids(before) - dirty
    before, after = seen["byte-level BPE"]
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == texts
    assert all(r.n_tokens == len(r.ids) for r in after.collect())
    whole = corpus_pipeline.run(spark, folder)
    assert ids(whole) == ids(after)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_operator_has_its_query(spark):
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    rows = lambda table: spark.read.parquet(f"{SF}/{table}.parquet")
    counts = {n: rows("pages" if n == "op6_warc" else "documents").count() for n in queries.QUERIES}
    # A row for each vector and each of its first eight components.
    counts["op12_whitening"] = 8 * rows("embeddings").where("embedding IS NOT NULL").count()
    assert {n: queries.QUERIES[n](spark, SF).count() for n in queries.QUERIES} == counts


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_archive_query_equals_its_statement(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    expected = con.execute(f"select {', '.join(columns)} from ({queries.ORACLES['op6_warc']})").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op6_warc"](spark, SF).select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_clashing_names_are_replaced_by_results_only(docs_of):
    docs = docs_of(["a b c"]).withColumn("hits", F.lit("old"))
    out = decontaminate.mark_hits(docs, docs.selectExpr("doc_id as item_id", "text"))
    assert out.columns == docs.columns and out.first().hits.n_words == 3 and out.first().n_words == "kept"
