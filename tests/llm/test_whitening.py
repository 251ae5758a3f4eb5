"""Whitening against numpy's own eigenvectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sprintmart.llm import whitening


def embeddings(spark, rows):
    data = [(i, v, 7, 0.5) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, component int, whitened double").repartition(3)


def matrices(rng: np.random.Generator):
    for d in (1, 2, 5, 17, 40):
        yield np.cov((rng.normal(size=(3 * d + 5, d)) * rng.uniform(0.1, 30, d)).T).reshape(d, d)
        yield np.cov(rng.normal(size=(max(2, d // 2), d)).T).reshape(d, d)
        q = np.linalg.qr(rng.normal(size=(d, d)))[0]
        both = q @ np.diag(np.where(np.arange(d) % 3 == 0, 5.0, 2.0)) @ q.T
        yield (both + both.T) / 2
        yield np.diag(rng.integers(1, 4, d).astype(float))
        yield np.zeros((d, d))


def test_eigenvectors_to_double_precision():
    for a in matrices(np.random.default_rng(1)):
        values, vectors = whitening.eigen(a)
        size = max(np.linalg.norm(a), 1e-300)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * size
        assert np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * size
        assert np.linalg.norm(vectors.T @ vectors - np.eye(len(a))) <= 1e-12


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.allclose(whitening.polar_factor(a), (v * np.sign(e)) @ v.T, atol=1e-12)


def check(rows, kept):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], object)
    n, d = len(kept), x.shape[1]
    s = x.sum(0)
    z = np.array((x * n - s), float) / n
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(rows) == n * min(d, 8)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for k, (i, _) in enumerate(kept):
        deviation = int(((x[k] * n - s) ** 2).sum())
        for c in range(1, min(d, 8) + 1):
            assert any(r.deviation == deviation and r.n == n for r in by_id[i][c])
    for c in range(min(d, 8)):
        assert rows[0].identity_error is None or rows[0].identity_error <= 1e-4
        own = [r for r in rows if r.component == c + 1]
        assert all(abs(r.explained - values[c] / np.trace(cov)) <= 1e-9 for r in own)
        if len({i for i, _ in kept}) == n:
            got = {r.vec_id: r.whitened for r in own}
            want = z @ vectors[:, c] / np.sqrt(values[c])
            flip = np.sign(sum(got[i] * w for (i, _), w in zip(kept, want)))
            assert max(abs(got[i] * flip - w) for (i, _), w in zip(kept, want)) < 1e-6


@pytest.mark.parametrize("d", [1, 3, 12])
def test_whitened_rows(spark, d):
    rng = np.random.default_rng(d)
    rows = [(i, (rng.normal(size=d) * np.arange(1, d + 1)).tolist()) for i in range(120)]
    odd = [(900, None), (901, [None] * d), (902, [float("nan")] * d), (903, [float("inf")] * d), (904, [1.0] * (d + 1)), (905, [])]
    found = whitening.whitened(embeddings(spark, rows + odd))
    check(found.collect(), rows)


def test_repeats_null_ids_and_tables_without_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1), rng.gauss(0, 5)]) for i in range(40)]
    again = whitening.whitened(embeddings(spark, rows + rows[:10] + [(None, [0.5, 0.5])])).collect()
    check([r for r in again], rows + rows[:10] + [(None, [0.5, 0.5])])
    empty = whitening.whitened(embeddings(spark, [(1, None)]))
    assert empty.collect() == [] and empty.columns == again[0].__fields__
    # Without variance there are components, but nothing to scale by.
    flat = whitening.whitened(embeddings(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect()
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in flat} == {(None, None, 0, None)}
    alone = whitening.whitened(embeddings(spark, [(1, [1.0, 2.0])])).collect()
    assert [r.whitened for r in alone] == [None, None]


def test_large_entries_stay_exact(spark):
    rows = [(0, [3.0e9, 1.0]), (1, [-3.0e9, 2.0]), (2, [1.0e38, -1.0e38]), (3, [0.0, 0.0])]
    got = whitening.whitened(embeddings(spark, rows)).collect()
    x = [[math.floor(1024 * max(-2.0**40, min(2.0**40, float(np.float32(c))))) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((4 * c - t) ** 2 for c, t in zip(x[i], s)) for i in range(4)}
    assert {r.vec_id: int(r.deviation_exact) for r in got} == want
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 2**63 else None) for r in got)


def test_partitions_do_not_matter(spark):
    rng = random.Random(8)
    docs = embeddings(spark, [(i, [rng.gauss(0, k + 1) for k in range(6)]) for i in range(200)])
    a, b = ({(r.vec_id, r.component): r.whitened for r in whitening.whitened(d).collect()} for d in (docs, docs.repartition(7)))
    assert a == b
