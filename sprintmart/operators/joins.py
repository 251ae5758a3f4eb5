"""Equi-joins with the null and fan-out behaviour the mart needs.

None of them hints a broadcast for data that can grow: Spark broadcasts a side when its measured
size allows and otherwise shuffles both, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = {"tinyint", "smallint", "int", "bigint"}
_NUMBERS = _WHOLE | {"float", "double"}


def _common_type(a: str, b: str) -> str:
    """The type two keys are compared in; keys that no comparison fits are an error."""
    if a == b:
        return a
    if {a, b} <= _WHOLE:
        return "bigint"
    if {a, b} <= _NUMBERS or all(t in _NUMBERS or t.startswith("decimal") for t in (a, b)):
        return "double"
    raise TypeError(f"keys of type {a} and {b} are not alike")


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    null_safe: bool = False,
    spread_by: str | None = None,
) -> DataFrame:
    """Left equi-join that keeps the 1:N fan-out; the right key column is dropped.

    Meant for a right side with few rows per key; ``skew.left_fan_out`` is for the other case.
    With ``null_safe`` a NULL key matches a NULL key. Without it NULL keys match nothing; where
    many rows may lack the key, ``spread_by`` names a column that varies, and they are spread by
    it rather than sent to the one task NULL hashes to.
    """
    lookup = right.withColumn("_rkey", F.col(right_key)).drop(right_key)
    if null_safe:
        return left.join(lookup, F.col(left_key).eqNullSafe(F.col("_rkey")), "left").drop("_rkey")
    if spread_by is None:
        return left.join(lookup, F.col(left_key) == F.col("_rkey"), "left").drop("_rkey")
    common = _common_type(left.select(left_key).dtypes[0][1], lookup.select("_rkey").dtypes[0][1])
    # Each value of the other column is a stand-in of its own, however many rows lack the key.
    stand_in = F.concat(F.lit("\0"), F.xxhash64(F.col(spread_by)).cast("string"))
    keyed = left.withColumn("_lkey", F.coalesce(F.col(left_key).cast(common).cast("string"), stand_in))
    lookup = lookup.withColumn("_rkey", F.col("_rkey").cast(common).cast("string"))
    # The stand-in only steers the shuffle: a row without a key matches nothing.
    test = (F.col("_lkey") == F.col("_rkey")) & F.col(left_key).isNotNull()
    return keyed.join(lookup, test, "left").drop("_lkey", "_rkey")


def absent_from(
    left: DataFrame,
    right: DataFrame,
    pairs: Mapping[str, str],
    left_skew: bool = False,
    right_distinct: bool = False,
) -> DataFrame:
    """The left rows whose key has no partner; a NULL key has none.

    Only distinct keys of the right side are shuffled, so many versions of one key cost one row.
    With ``left_skew`` the distinct keys are shuffled once more, right below the join: only then
    can adaptive execution split a key, or the missing keys, that many left rows share.
    ``right_distinct`` says the right side holds each key once already.
    """
    names = [f"_k{i}" for i in range(len(pairs))]
    keys = right.select(*[F.col(b).alias(n) for b, n in zip(pairs.values(), names)])
    keys = keys.dropna(subset=names)
    if not right_distinct:
        keys = keys.distinct()
    test: Column = F.lit(True)
    for a, n in zip(pairs, names):
        # Null-safe equality changes the hashed expression, hence the second shuffle. The keys
        # hold no NULL, so the outcome is the same.
        test = test & (F.col(a).eqNullSafe(F.col(n)) if left_skew else F.col(a) == F.col(n))
    return left.join(keys, test, "left_anti")


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """SQL ``left_key NOT IN (SELECT right_key ...)``, with its three-valued logic, at any size.

    One NULL on the right keeps nothing, and a NULL on the left is kept only when the right side
    is empty. The built-in null-aware join broadcasts the whole right side; here the anti-join is
    an ordinary one and a scalar subquery supplies what decides the NULL cases.
    """
    rows, keys = F.count(F.lit(1)), F.count(F.col(right_key))
    # 0: nothing on the right, 1: keys only, 2: at least one NULL.
    state = right.agg(
        F.when(rows == 0, F.lit(0)).when(rows == keys, F.lit(1)).otherwise(F.lit(2)).alias("state")
    ).scalar()
    allowed = F.when(F.col(left_key).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return absent_from(left, right, {left_key: right_key}).filter(state <= allowed)


def dictionary(mapping: Mapping[str, int | str]) -> Column:
    """A literal map for :func:`look_up`; its size is that of the Python mapping."""
    items: list[Column] = []
    for key, value in mapping.items():
        items += [F.lit(key), F.lit(value)]
    return F.create_map(*items)


def look_up(column: Column, mapping: Mapping[str, int | str], default: int | str) -> Column:
    """``mapping[column]``, or ``default`` for a value the mapping does not list or for NULL."""
    if not mapping:
        return F.lit(default)
    return F.coalesce(F.try_element_at(dictionary(mapping), column), F.lit(default))
