"""Joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed partition only when the shuffle feeds the join directly, and in
a left join only on the left. The other cases are salted here: hot keys are found by a
pre-aggregated count, each gets as many sub-keys as it has times ``HOT_ROWS`` rows, its rows are
spread over them by a hash of all their columns, and the few matching rows of the other side are
repeated once per sub-key. The sub-key depends on the row alone, so it spreads rows that one
partition holds already, and a recomputed task gives its rows the same one again. Rows equal in
every column share a sub-key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key counts as hot from this many rows on, so the hot keys of N rows number at most
# N / HOT_ROWS. Whether that list is broadcast is left to its measured size.
HOT_ROWS = 1_000_000

# Rows without a key match nothing; as many sub-keys as an integer has spread any number of them.
_NULL_SALTS = 2**31 - 1


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n): partial counts are combined before the shuffle, so a hot key costs nothing."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keys, salts) of the keys with at least ``hot_rows`` rows: one per ``hot_rows`` at most."""
    if hot_rows < 2:
        raise ValueError("hot_rows must be at least 2")
    salts = F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("salts")
    return counts.filter(F.col("n") >= hot_rows).select(*keys, salts)


def spread_over(df: DataFrame, salts: Column) -> Column:
    """A sub-key from a hash of the whole row."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*hashable), salts).cast("int")


def _every(salts: Column) -> Column:
    return F.sequence(F.lit(0), salts - F.lit(1))


def distinct_after_join(df: DataFrame) -> DataFrame:
    """The distinct rows of a join's result, leaving the join free to be split.

    A plain distinct makes use of the join's partitioning, and adaptive execution does not split
    a join whose partitioning is used. Grouping by the row as one value does not ask for it; a
    hot key still shrinks to one row per task before the shuffle.
    """
    return df.select(F.struct(*df.columns).alias("row")).distinct().select("row.*")


def same_keys(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    tests = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, tests)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    hot: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """``left`` joined with ``right`` on ``pairs`` of (left, right) columns, hot keys salted.

    ``hot`` is a result of :func:`hot_keys` over the left columns. ``how`` is any type that keeps
    or drops left rows: inner, left, left_semi or left_anti. The right key columns are dropped;
    the other right columns must not clash with left ones.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type {how!r}")
    names = [a for a, _ in pairs]
    marks = [f"_hot_{i}" for i in range(len(names))]
    renamed = [F.col(n).alias(m) for n, m in zip(names, marks)]
    flagged = hot.select(*renamed, F.col("salts").alias("_salts"))

    def tag(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        test = same_keys(list(zip(columns, marks)), null_safe)
        return df.join(flagged, test, "left").drop(*marks)

    salts = F.col("_salts")
    left_salt = F.when(salts.isNotNull(), spread_over(left, salts)).otherwise(F.lit(-1))
    left_salted = tag(left, names).withColumn("_salt", left_salt).drop("_salts")

    right_keys = [f"_right_{i}" for i in range(len(names))]
    others = [c for c in right.columns if c not in {b for _, b in pairs}]
    right_named = right.select(*[F.col(b).alias(k) for (_, b), k in zip(pairs, right_keys)], *others)
    right_salts = F.when(salts.isNotNull(), _every(salts)).otherwise(F.array(F.lit(-1)))
    right_salted = (
        tag(right_named, right_keys).withColumn("_right_salt", F.explode(right_salts)).drop("_salts")
    )
    test = same_keys(list(zip(names, right_keys)), null_safe) & (
        F.col("_salt") == F.col("_right_salt")
    )
    return left_salted.join(right_salted, test, how).drop("_salt", "_right_salt", *right_keys)


def left_fan_out(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left equi-join for a right side that may hold very many rows of one key.

    The hot keys of the right side are salted and the left rows that have them repeated. A hot key
    has matches, so a repeated left row without one in its sub-key is surplus and dropped; every
    other left row without a match stays. Repeating costs little beside the result: one copy per
    ``hot_rows`` rows it yields. Left rows without a key match nothing and are spread. The right
    key column is dropped.
    """
    hot = hot_keys(key_counts(right, [right_key]), [right_key], hot_rows)
    flagged = hot.select(F.col(right_key).alias("_hot_key"), F.col("salts").alias("_salts"))

    def tag(df: DataFrame, key: str) -> DataFrame:
        return df.join(flagged, F.col(key) == F.col("_hot_key"), "left").drop("_hot_key")

    salts = F.col("_salts")
    left_salts = (
        F.when(salts.isNotNull(), _every(salts))
        .when(F.col(left_key).isNull(), F.array(F.lit(-1) - spread_over(left, F.lit(_NULL_SALTS))))
        .otherwise(F.array(F.lit(0)))
    )
    left_salted = tag(left, left_key).withColumn("_salt", F.explode(left_salts))
    lookup = right.withColumn("_rkey", F.col(right_key)).drop(right_key)
    right_salt = F.when(salts.isNotNull(), spread_over(lookup, salts)).otherwise(F.lit(0))
    right_salted = tag(lookup, "_rkey").withColumn("_right_salt", right_salt).drop("_salts")
    test = (F.col(left_key) == F.col("_rkey")) & (F.col("_salt") == F.col("_right_salt"))
    joined = left_salted.join(right_salted, test, "left")
    needed = F.col("_salts").isNull() | F.col("_rkey").isNotNull()
    return joined.filter(needed).drop("_salts", "_salt", "_right_salt", "_rkey")
