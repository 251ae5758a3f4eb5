"""Embedding whitening: principal components by spectral divide-and-conquer on QDWH polar decompositions.

1. Entries become whole numbers (``SCALE`` a unit, shifted by ``SHIFT``), so counts, sums and centred second moments
   are whole numbers too: they are added exactly in any order, and a lost task changes nothing.
2. The covariance (a matrix of the dimension squared, whatever the number of rows) is split: the polar factor of the
   shifted matrix is the sign of its spectrum, which gives the projector on all larger eigenvalues; bases of its
   range and null space leave two smaller matrices, and so on down to single components.
3. Mean and components are broadcast, and every row is projected; the covariance of the projections is measured
   over all rows.

A row is left out if its vector is null, or holds a null or non-finite entry. So is a vector whose length is not the
most frequent one (of equally frequent ones the longest). Entries beyond +-``MAX_ENTRY`` count as that. Repeated
rows count and are returned each; a null id stays null. An empty table gives no rows. Directions without variance
(fewer vectors than dimensions, constant entries) have components but null projections; with no variance
at all ``explained`` is null. Equal eigenvalues have any orthonormal components of their space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
MAX_ENTRY = 2.0**40

#: The components go to every task: 8 bytes times dimension times components.
MAX_DIMENSION = 4096

EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley iterations (QDWH)."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    # A lower bound of the least singular value; too low a bound costs steps, not accuracy.
    low = EPS / np.sqrt(n)
    eye = np.eye(n)
    for _ in range(most):
        d = np.cbrt(4 * (1 - low**2) / low**4) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * root))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, eye)))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            z = np.linalg.cholesky(eye + wc * (x.T @ x))
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, np.linalg.solve(z, x.T)).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        done = np.linalg.norm(new - x) <= (4 * EPS) ** (1 / 3) * np.sqrt(n) and low > 1 - 1e-8
        x = new
        if done:
            break
    return x


def _range_and_null(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of its null space: the columns with the largest remainders span
    the range (pivoted, then orthogonalised once more)."""
    n = len(projector)
    rest, picked = projector.copy(), []
    for _ in range(rank):
        k = int(np.argmax((rest * rest).sum(0)))
        q = rest[:, k] / np.linalg.norm(rest[:, k])
        rest -= np.outer(q, q @ rest)
        picked.append(k)
    q, _ = np.linalg.qr(np.hstack((projector[:, picked], np.eye(n))))
    basis = projector @ q[:, :rank]
    q, _ = np.linalg.qr(np.hstack((basis, q[:, rank:n])))
    return q[:, :rank], q[:, rank:]


def _split(a: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of a symmetric matrix, that of larger eigenvalues first; None if its
    eigenvalues cannot be told apart above ``floor``."""
    n = len(a)
    # Gershgorin bounds hold all eigenvalues, of which at least one lies on either side of the mean.
    radius = np.abs(a).sum(1) - np.abs(np.diag(a))
    bottom, top = float((np.diag(a) - radius).min()), float((np.diag(a) + radius).max())
    mean = float(np.trace(a)) / n
    if np.linalg.norm(a - mean * np.eye(n)) <= floor:
        return None
    shift = float(np.median(np.diag(a)))
    for _ in range(60):
        sign = polar_factor(a - shift * np.eye(n))
        rank = int(round((np.trace(sign) + n) / 2))
        if 0 < rank < n:
            large, small = _range_and_null((sign + np.eye(n)) / 2, rank)
            # A shift on top of an eigenvalue leaves its sign open, and the spaces are then not invariant.
            if np.linalg.norm(large.T @ a @ small) <= 8 * floor:
                return large, small
            shift += (top - bottom) * 1e-3
            continue
        if rank == 0:
            top = shift
        else:
            bottom = shift
        shift = mean if bottom < mean < top and shift != mean else (bottom + top) / 2
    return None


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns."""
    n = len(a)
    floor = 4 * EPS * max(np.linalg.norm(a), np.finfo(float).tiny) * np.sqrt(n)
    done: list[np.ndarray] = []
    open_ = [np.eye(n)] if n else []
    while open_:
        basis = open_.pop()
        halves = _split(basis.T @ a @ basis, floor) if basis.shape[1] > 1 else None
        if halves is None:
            done.append(basis)
        else:
            open_ += [basis @ half for half in halves]
    vectors = np.linalg.qr(np.hstack(done))[0] if done else np.zeros((0, 0))
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.clip(values, -MAX_ENTRY, MAX_ENTRY)).astype(np.int64) + SHIFT


def _vectors(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    """The rows of a batch of whole vectors as a matrix of whole numbers."""
    column = batch.column(batch.schema.get_field_index("vector"))
    return _whole(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension))


def _squares(rows: np.ndarray) -> np.ndarray:
    """rows.T @ rows of whole numbers, exact; an object array where 64 bits may not do."""
    most = int(np.abs(rows).max(initial=0))
    if most**2 * max(1, len(rows)) < 2**53:
        part = rows.astype(np.float64)
        return (part.T @ part).astype(np.int64)
    return rows.T.astype(object) @ rows.astype(object)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with a vector of finite entries, as array<double> under the name ``vector``."""
    kept = rows.withColumn("vector", F.col(vector).cast("array<double>")).where(
        F.col("vector").isNotNull()
        & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & (F.size("vector") > 0)
    )
    return kept


@dataclass(frozen=True)
class Whitening:
    """Whole-number mean (``sums`` over ``n``), components as columns, eigenvalues and trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def weights(self) -> np.ndarray:
        """Components over the root of their eigenvalue; NaN where there is no variance."""
        floor = self.dimension * EPS * self.trace * 1e4
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.components / np.where(self.values > floor, np.sqrt(np.maximum(self.values, 0)), np.nan)


def _totals(rows: DataFrame, per_batch) -> dict[tuple[int, int], int]:
    """Sums over all rows of the whole matrices that ``per_batch`` makes of a partition's batches, by place. Each
    task sends one matrix; they are added before the driver gets one number a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(batch).astype(object)
                total = part if total is None else total + part
        if total is not None:
            r, c = np.indices(total.shape)
            # Decimals of 38 digits hold any sum that whole numbers of 53 bits can reach here.
            yield pa.RecordBatch.from_arrays(
                [pa.array(r.ravel().astype(np.int32)), pa.array(c.ravel().astype(np.int32)),
                 pa.array([str(v) for v in total.ravel()])],
                ["r", "c", "v"],
            )

    parts = rows.mapInArrow(run, "r int, c int, v string")
    sums = parts.groupBy("r", "c").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    return {(s["r"], s["c"]): int(s["v"]) for s in sums}


def fit(vectors: DataFrame, dimension: int, most: int) -> Whitening:
    """Mean and the first components of all vectors."""
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; components of at most {MAX_DIMENSION} are broadcast")
    only = vectors.select("vector")

    def first(batch: pa.RecordBatch) -> np.ndarray:
        x = _vectors(batch, dimension)
        return np.concatenate(([len(x)], x.sum(0)))[None, :]

    found = _totals(only, first)
    n, sums = found[0, 0], [found[0, k + 1] for k in range(dimension)]
    centre = np.array([round(s / n) for s in sums], np.int64)

    def second(batch: pa.RecordBatch) -> np.ndarray:
        return _squares(_vectors(batch, dimension) - centre)

    squares = _totals(only, second)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    # Exact up to here: the whole centre differs from the mean by less than one.
    v = np.array([[(n * squares[i, j] - rest[i] * rest[j]) / (n * n) for j in range(dimension)] for i in range(dimension)])
    values, components = eigen(v)
    return Whitening(n, sums, values[:most], components[:, :most], float(np.trace(v)))


def _deviation(x: np.ndarray, model: Whitening) -> list[int]:
    """Sum over the entries of (n x - S)^2 of each row, exact."""
    most = max(int(np.abs(x).max(initial=0)) * model.n, max(abs(s) for s in model.sums))
    whole = np.int64 if (2 * most) ** 2 * model.dimension < 2**63 else object
    z = x.astype(whole) * model.n - np.array(model.sums, whole)
    return (z * z).sum(1).tolist()


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    # The whole part of the mean goes first, so that no digits are lost.
    centre = np.array([s // model.n for s in model.sums], np.int64)
    part = np.array([(s % model.n) / model.n for s in model.sums])
    return ((x - centre) - part) @ model.weights()


def _identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the measured covariance of all projections minus the identity, where there is variance."""
    use = np.flatnonzero(~np.isnan(model.weights()[0])) if model.dimension else []
    if not len(use):
        return None
    m = len(use)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, squares = 0, np.zeros(m), np.zeros((m, m))
        for batch in batches:
            if batch.num_rows:
                w = _projected(_vectors(batch, model.dimension), model)[:, use]
                own = w.mean(0)
                gap, both = own - mean, n + len(w)
                squares += (w - own).T @ (w - own) + np.outer(gap, gap) * (n * len(w) / both)
                mean, n = mean + gap * (len(w) / both), both
        if n:
            # Sums about zero, which is the mean up to rounding.
            flat = np.concatenate(((squares + n * np.outer(mean, mean)).ravel(), n * mean))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["k", "v"])

    rows = vectors.select("vector").mapInArrow(moments, "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v"))
    flat = np.zeros(m * m + m)
    for row in rows.collect():
        flat[row["k"]] = row["v"]
    mean = flat[m * m :] / model.n
    return float(np.abs(flat[: m * m].reshape(m, m) / model.n - np.outer(mean, mean) - np.eye(m)).max())


_ROWS = (
    "id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), whitened double,"
    " explained double, identity_error double"
)


def whitened(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = 8) -> DataFrame:
    """A row for each vector and each of the first components: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``. ``deviation`` is null where 64 bits do not hold it;
    ``deviation_exact`` has 38 digits (null beyond)."""
    found = usable(rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vector")), "vector")
    sizes = found.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("c"))
    best = sizes.orderBy(F.desc("c"), F.desc("d")).first()
    if best is None:
        return rows.sparkSession.createDataFrame([], _ROWS).withColumnRenamed("id", "vec_id")
    dimension = best["d"]
    vectors = found.where(F.size("vector") == dimension)
    model = fit(vectors, dimension, most)
    error = _identity_error(vectors, model)
    parts = len(model.values)
    explained = [float(e / model.trace) if model.trace > 0 else None for e in model.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, dimension)
            times = lambda values: [v for v in values for _ in range(parts)]
            deviation = _deviation(x, model)
            w = _projected(x, model).ravel()
            rows_ = len(x) * parts
            exact = [v if v < 10**38 else None for v in deviation]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(times(batch.column(0).to_pylist()), pa.int64()),
                    pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows_, model.n)),
                    pa.array(times([v if v < 2**63 else None for v in deviation]), pa.int64()),
                    pa.array(times(exact), pa.decimal128(38, 0)),
                    pa.array(w, pa.float64(), mask=np.isnan(w)),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * rows_, pa.float64()),
                ],
                [c.split()[0] for c in _ROWS.split(", ")],
            )

    return vectors.select("id", "vector").mapInArrow(project, _ROWS).withColumnRenamed("id", "vec_id")
