"""Winnowing against a plain version, and the match guarantee."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from sprintmart.llm import queries, winnowing
from tests.llm.conftest import ODD

GRAM, WINDOW = winnowing.GRAM, winnowing.WINDOW


def plain(text: str | None) -> list[tuple[int, int]]:
    data = (text or "").encode()
    if len(data) < GRAM:
        return [(zlib.crc32(data), 0)] if data else []
    hashes = [zlib.crc32(data[i : i + GRAM]) for i in range(len(data) - GRAM + 1)]
    out: list[tuple[int, int]] = []
    for i in range(max(1, len(hashes) - WINDOW + 1)):
        window = hashes[i : i + WINDOW]
        at = i + max(k for k, v in enumerate(window) if v == min(window))
        if not out or out[-1] != (hashes[at], at):
            out.append((hashes[at], at))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    sizes = [1, 19, 20, 21, 50, 51, 52, 80, 103, 104, 105, 160, 320, 900, 5_000, 9_000]
    made = ["".join(rng.choice("abcdé ") for _ in range(rng.choice(sizes))) for _ in range(70)]
    return made + [t for t in ODD if t is None or len(t) < 30_000] + ["z" * 500, "é漢字😀 x" * 40]


def test_fingerprints_equal_the_plain_version(docs_of, texts):
    rows = docs_of(texts).select("text", winnowing.fingerprint("text").alias("f")).collect()
    for r in rows:
        assert [(x.hash, x.position) for x in r.f] == plain(r.text)


def test_shared_bytes_share_a_hash_at_the_same_place(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for _ in range(200):
        shared, x, y = text(GRAM + WINDOW - 1), text(rng.randrange(300)), text(rng.randrange(300))
        rows.append((x + shared + text(rng.randrange(200)), y + shared + text(rng.randrange(200)), len(x), len(y)))
    docs = spark.createDataFrame(rows, "a string, b string, x long, y long").select(
        "x", "y", winnowing.fingerprint("a").alias("f"), winnowing.fingerprint("b").alias("g")
    )
    for r in docs.select("x", "y", winnowing.matches("f", "g").alias("m")).collect():
        assert any(m.x - r.x == m.y - r.y and 0 <= m.x - r.x < WINDOW for m in r.m)


def expected(rows):
    order = sorted(
        {(i is not None, i or 0, hashlib.md5((("" if i is None else str(i)) + "\n" + (t or "")).encode()).hexdigest(), t or "")
         for i, t in rows},
        reverse=True,
    )
    out = {}
    for k, (known, i, _, text) in enumerate(order):
        following = order[(k + 1) % len(order)]
        m = len(text) // 3
        out[i if known else None, text] = (text[: len(text) - m] + following[3][:m], following[3])
    return out


def jaccard(x, y):
    x, y = {h for h, _ in x}, {h for h, _ in y}
    return len(x & y) / len(x | y) if x | y else 1.0


def digits(marks):
    return "".join(f"{h:08x}" for h, _ in marks)


def test_the_query_equals_the_plain_version(spark, tmp_path, texts, monkeypatch):
    monkeypatch.setattr(winnowing, "PART_ROWS", 9)
    rows = [*enumerate(texts), (None, "no id " * 30), (None, None), (4, texts[4]), (4, "the same id with another text " * 20)]
    wide = [(i, t, "key", 1) for i, t in rows]
    spark.createDataFrame(wide, "doc_id long, text string, key string, next long").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    pairs = expected(rows)
    want = Counter()
    for i, t in rows:
        edited, following = pairs[i, t or ""]
        f, g = plain(t), plain(edited)
        want[i, len(t or ""), hashlib.sha256(edited.encode()).hexdigest(), digits(f), digits(g),
             round(jaccard(f, g), 9), round(jaccard(f, plain(following)), 9), f[-1][1] if f else 0] += 1
    frame = queries.QUERIES["op13_winnowing"](spark, str(tmp_path))
    got = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
         round(r.near_next, 9), r.last_position)
        for r in frame.collect()
    )
    assert got == want


def test_one_text_exchange_and_no_python(spark, docs_of, texts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = winnowing.edited_pairs(docs_of(texts))
        pairs.collect()
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan")[0]
    assert "ReusedExchange" in final and "Python" not in final and "Arrow" not in final


def test_tables_of_no_or_one_document(docs_of):
    assert winnowing.edited_pairs(docs_of([])).count() == 0
    row = winnowing.edited_pairs(docs_of(["abcdefghi"])).first()
    assert (row.edited, row.next_id, row.n_chars) == ("abcdefabc", 0, 9)
