"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintmart.llm import periodic_runs, queries
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing all words at all distances."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(24, 3 * q):
                found.setdefault((a, i + q - a), q)
    return sorted(((a, n_, q) for (a, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs) -> str:
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(rng: random.Random) -> list[int]:
    k = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(k) for _ in range(rng.choice([0, 1, 23, 24, 100, 300]))]
    for _ in range(rng.randint(0, 3)):
        base = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 13, 16, 17, 31, 33]))]
        if rng.random() < 0.3:
            # Nearly periodic by itself, as Fibonacci words and the like are.
            base = (base[: max(1, len(base) // 5)] * 6)[: len(base) - 1] + [99]
        n = rng.randint(1, 5 * len(base) + 20)
        at = rng.randint(0, len(words))
        words[at:at] = (base * (n // len(base) + 1))[:n]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(25):
        docs = [periodic(rng) for _ in range(rng.randint(1, 6))]
        offsets = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
        got = periodic_runs.find_runs(np.array([w for d in docs for w in d], np.int64), offsets)
        want = [(a + int(offsets[i]), n, q) for i, d in enumerate(docs) for a, n, q in plain_runs(d)]
        assert list(zip(*(c.tolist() for c in got))) == want


def test_structured_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") & 1 for i in range(512)]
    for words in (fib[-1], thue, thue * 3, [0] * 400, [0] * 200 + [1] + [0] * 200, list(range(130)) * 3):
        got = periodic_runs.find_runs(np.array(words), np.array([0, len(words)]))
        assert list(zip(*(c.tolist() for c in got))) == plain_runs(words)


def test_a_long_periodic_text_takes_few_candidates():
    words = np.tile(np.arange(50_000), 4)
    start, length, period = periodic_runs.find_runs(words, np.array([0, len(words)]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [200_000], [50_000])


def test_the_wavelet_tree_counts_and_finds():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    tree = periodic_runs.WaveletTree(values)
    low = rng.integers(0, 300, 500)
    high = low + rng.integers(0, 301 - low)
    x = rng.integers(0, 700, 500)
    want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(low, high, x)]
    assert tree.successor(low, high, x, np.full(500, 1000)).tolist() == want


def test_runs_of_texts(docs_of):
    rng = random.Random(9)
    texts = [" ".join(f"w{w}" for w in periodic(rng)) for _ in range(40)] + ODD + ["same words here " * 20] * 3
    docs = docs_of(texts)
    rows = docs.union(docs.where("doc_id = 1")).repartition(3).select(
        "doc_id", "text", periodic_runs.periodic_runs(F.col("text")).alias("p")
    ).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        words = WORD.findall(r.text or "")
        if len(words) > 5_000:
            assert [tuple(x) for x in r.p.runs] == [(0, len(words), 1)]
            continue
        want = plain_runs(words)
        assert ([tuple(x) for x in r.p.runs], r.p.n_words) == (want, len(words))
        assert r.p.collapsed == collapsed(words, want)
    assert docs_of([]).select(periodic_runs.periodic_runs(F.col("text"))).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(F.col("text"), 8)


def test_the_query_equals_brute_force(spark, tmp_path, docs_of):
    rng = random.Random(21)
    texts = [" ".join(f"w{w}" for w in periodic(rng)) for _ in range(60)] + [None, "", "  ", "one"] + [
        "\t".join(f"v{rng.randrange(90)}" for _ in range(rng.randint(1, 400))) for _ in range(60)
    ]
    docs = docs_of(texts, first=100)
    docs.union(spark.createDataFrame([(None, texts[0], "", "")], docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) + 1
    planted = 0
    for i, text in [(None, texts[0]), *enumerate(texts, 100)]:
        words = WORD.findall(text or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]
            planted += 1
        runs = plain_runs(words)
        r = got[i]
        assert r.n_runs == len(runs)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (None if best is None else 1000 * best[1] // best[2])
        lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 3
