"""Rows whose key occurs several times, and rows whose key occurs once.

A NULL key equals a NULL key here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintmart.operators.skew import HOT_ROWS, hot_keys, key_counts, same_keys, spread_over


def _counted(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """``df`` with ``_hot``, whether the row's key is hot, and ``_n``, the rows of a key that is not.

    Only the keys are counted beforehand, combined before the shuffle. The rows are shuffled once,
    for a window over the key; those of a hot key are spread over sub-keys, since nothing has to
    be counted for them: they are repeated.
    """
    hot = hot_keys(key_counts(df, keys), keys, hot_rows)
    marks = [f"_hot_{i}" for i in range(len(keys))]
    flagged = hot.select(*[F.col(k).alias(m) for k, m in zip(keys, marks)], F.col("salts").alias("_salts"))
    salts = F.col("_salts")
    tagged = df.join(flagged, same_keys(list(zip(keys, marks)), null_safe=True), "left").drop(*marks)
    tagged = tagged.withColumn("_salt", F.when(salts.isNotNull(), spread_over(df, salts)).otherwise(F.lit(-1)))
    group = Window.partitionBy(*keys, "_salt")
    return tagged.select(*df.columns, salts.isNotNull().alias("_hot"), F.count(F.lit(1)).over(group).alias("_n"))


_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key occurs exactly once.

    An aggregate combined before the shuffle, so a key held by a third of the rows reaches the
    reducers as one row per map task. Only groups of one row survive, so each column may be taken
    on its own, which hashes where columns have a fixed width. Other rows are joined with the keys
    that occur once; no such key is hot.
    """
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in df.schema.fields):
        rest = [c for c in df.columns if c not in keys]
        picked = [F.any_value(F.col(f"`{c}`")).alias(c) for c in rest]
        grouped = df.groupBy(*keys).agg(*picked, F.count(F.lit(1)).alias("_n"))
        return grouped.filter("_n = 1").select(*df.columns)
    marks = [f"_once_{i}" for i in range(len(keys))]
    once = key_counts(df, keys).filter("n = 1").select(*[F.col(k).alias(m) for k, m in zip(keys, marks)])
    return df.join(once, same_keys(list(zip(keys, marks)), null_safe=True), "left_semi")


def duplicate_rows(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row whose key occurs more than once."""
    return _counted(df, keys, hot_rows).filter("_hot or _n > 1").drop("_hot", "_n")


def split_by_repetition(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All rows with ``repeated``, whether their key occurs more than once: both parts in one pass."""
    counted = _counted(df, keys, hot_rows)
    return counted.withColumn("repeated", F.expr("_hot or _n > 1")).drop("_hot", "_n")
