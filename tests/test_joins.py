from __future__ import annotations

import random

import pytest
from conftest import forced_skew, plan_of, tuples
from pyspark.sql import functions as F

from sprintmart.operators.consolidate import CUSTOMER_CONSOLIDATION, consolidate
from sprintmart.operators.dedup import duplicate_rows, unique_rows
from sprintmart.operators.joins import absent_from, left_lookup, look_up, not_in
from sprintmart.operators.skew import (
    distinct_after_join,
    hot_keys,
    key_counts,
    left_fan_out,
    salted_join,
)


def frame(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


@pytest.mark.parametrize(
    ("left", "right"),
    [
        ([1, 2, None], [2, 3]),
        ([1, 2, None], [2, None]),
        ([1, 2, None], []),
        ([], [1]),
        ([1, 1, 2], [3, 3]),
    ],
)
def test_not_in_follows_three_valued_logic(spark, left, right):
    l, r = frame(spark, left, "a"), frame(spark, right, "b")
    l.createOrReplaceTempView("l")
    r.createOrReplaceTempView("r")
    want = spark.sql("select a from l where a not in (select b from r)")
    got = not_in(l, r, "a", "b")
    assert tuples(got) == tuples(want)
    assert "BroadcastNestedLoop" not in plan_of(got)


def test_absent_from_keeps_null_keys(spark):
    got = absent_from(frame(spark, [1, None, 2], "a"), frame(spark, [1, 1, None], "b"), {"a": "b"})
    assert tuples(got) == [(2,), (None,)]
    assert "LeftAnti" in plan_of(got)


@pytest.mark.parametrize("spread", [None, "i"])
def test_left_lookup_keeps_fan_out_and_missing_keys(spark, spread):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "z")], "i int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    got = left_lookup(left, right, "k", "k", spread_by=spread)
    assert got.columns == ["i", "k", "v"]
    assert tuples(got) == sorted([(1, "a", 1), (1, "a", 2), (2, None, None), (3, "b", 3), (4, "z", None)], key=repr)


@pytest.mark.parametrize("hot_rows", [3, 100, 10**6])
def test_left_fan_out_equals_the_left_join(spark, hot_rows):
    left = spark.createDataFrame(
        [(1, 7), (2, None), (3, 8), (4, 999), (5, 7), (6, None), (7, 300)], "i int, k int"
    )
    right = skewed(spark, 600).select(F.col("k").alias("rk"), F.col("i").alias("v"))
    got = left_fan_out(left, right, "k", "rk", hot_rows)
    want = left.join(right, left.k == right.rk, "left").drop("rk")
    assert got.columns == want.columns and tuples(got) == tuples(want)


def test_left_fan_out_splits_the_hot_key(spark):
    left = spark.createDataFrame([(1, 7), (2, 9)], "i int, k int")
    right = skewed(spark).select(F.col("k").alias("rk"), F.col("i").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = left_fan_out(left, right, "k", "rk", 250)
        parts = got.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 2
    with pytest.raises(ValueError):
        left_fan_out(left, right, "k", "rk", 1)


@pytest.mark.parametrize("left_skew", [True, False])
def test_absent_from_with_skew(spark, left_skew):
    left = skewed(spark, 600)
    right = spark.createDataFrame([(k,) for k in [7, 7, 8, None, *range(100, 300)]], "rk int")
    got = absent_from(left, right, {"k": "rk"}, left_skew)
    assert tuples(got) == tuples(left.join(right, left.k == right.rk, "left_anti"))


def test_hot_keys_are_split_on_either_side(spark):
    many = spark.range(0, 60000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    few = spark.range(0, 60000, 1, 12).select(F.col("id").cast("int").alias("rk"), F.md5(F.col("id").cast("string")).alias("w"))
    assert "skew=true" in forced_skew(spark, lambda: left_lookup(many, few, "k", "rk"))
    assert "skew=true" in forced_skew(spark, lambda: absent_from(many, few.filter("rk > 50000"), {"k": "rk"}, True))
    plain = many.select("k").join(few.select("rk"), F.col("k") == F.col("rk"), "left_semi")
    assert "skew=true" in forced_skew(spark, lambda: distinct_after_join(plain), "1KB")
    assert "skew=true" not in forced_skew(spark, plain.distinct, "1KB")
    assert distinct_after_join(plain).count() == 40000


def test_left_lookup_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "i int, k string")
    right = spark.createDataFrame([("a", 1), (None, 4)], "k string, v int")
    assert tuples(left_lookup(left, right, "k", "k", null_safe=True)) == [(1, "a", 1), (2, None, 4)]


def test_missing_keys_are_spread(spark):
    left = spark.range(20000).select(F.col("id").alias("i"), F.lit(None).cast("string").alias("k"))
    right = spark.createDataFrame([("a", 1)], "rk string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = left_lookup(left, right, "k", "rk", spread_by="i")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and len(sizes) == 4 and max(sizes) < 7000


def skewed(spark, n=6000):
    """A third of the rows share a key, another part has none."""
    rng = random.Random(5)
    rows = [(i, 7 if i % 3 == 0 else None if i % 11 == 0 else rng.randrange(500)) for i in range(n)]
    return spark.createDataFrame(rows, "i int, k int").repartition(8)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame([(7, "x"), (7, "y"), (8, "z"), (None, "n")], "rk int, v string")
    hot = hot_keys(key_counts(left, ["k"]), ["k"], 450)
    assert [(r.k, r.salts) for r in hot.collect()] == [(7, 5)]
    got = salted_join(left, right, [("k", "rk")], how, hot)
    want = left.join(right, left.k == right.rk, how).drop("rk")
    assert got.columns == want.columns and tuples(got) == tuples(want)


def test_salted_join_splits_the_hot_key(spark):
    left = skewed(spark)
    right = spark.createDataFrame([(7, "x")], "rk int, v string")
    hot = hot_keys(key_counts(left, ["k"]), ["k"], 250)
    got = salted_join(left, right, [("k", "rk")], "inner", hot)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1 and sum(p["count"] for p in parts) == left.filter("k = 7").count()


def test_unsupported_salted_join(spark):
    with pytest.raises(ValueError):
        salted_join(skewed(spark, 10), skewed(spark, 10), [("k", "k")], "full", skewed(spark, 10))


@pytest.mark.parametrize("hot_rows", [2, 3, 100, 10**6])
def test_duplicate_and_unique_rows(spark, hot_rows):
    df = skewed(spark, 900)
    counts = {}
    rows = [tuple(r) for r in df.collect()]
    for _, k in rows:
        counts[k] = counts.get(k, 0) + 1
    once = sorted((r for r in rows if counts[r[1]] == 1), key=repr)
    more = sorted((r for r in rows if counts[r[1]] > 1), key=repr)
    assert tuples(unique_rows(df, ["k"])) == once
    assert tuples(duplicate_rows(df, ["k"], hot_rows)) == more
    assert "Window" not in plan_of(unique_rows(df, ["k"]))


def test_identical_rows_stay_whole(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")], "k int, v string")
    assert duplicate_rows(df, ["k"], 10).count() == 50
    assert tuples(unique_rows(df, ["k"])) == [(2, "b")]


def test_look_up(spark):
    df = spark.createDataFrame([("a",), ("q",), (None,)], "t string")
    assert [r[0] for r in df.select(look_up(F.col("t"), {"a": 0, "b": 1}, -1)).collect()] == [0, -1, -1]
    assert [r[0] for r in df.select(look_up(F.col("t"), {}, "?")).collect()] == ["?"] * 3


RECORD = (
    "task_id string, ord int, task_name string, customer string, slack_channel string, team string,"
    " crm_id string, currency string, plan_points double, monthly_revenue double, term bigint,"
    " has_growth_formula boolean, start_date string, due_date string, date_created string,"
    " date_updated string, status string"
)


def record(key, ord, status, points, name="n", team=None, term=None, start="2024-01-02", currency="BRL"):
    return (
        key, ord, name, "c", None, team, "1", currency, points, points, term, None,
        start, start, start, start, status,
    )


def test_consolidation_rules(spark):
    rows = [
        record("once", 1, "active", 5.0),
        record("mixed", 2, "cancelled", 9.0, name="b", team="t", currency="USD"),
        record("mixed", 1, "active", 1.5, name="a", start="2024-01-01", currency=None),
        record("mixed", 3, "active", None, name="a", term=4, start=None),
        record("off", 1, "cancelled", 3.0),
        record("off", 2, None, 4.0),
        record(None, 1, "active", 1.0),
        record(None, 2, "active", 1.0),
    ]
    df = spark.createDataFrame(rows, RECORD)
    got = {r.task_id: r for r in consolidate(df, CUSTOMER_CONSOLIDATION, F.col("ord")).collect()}
    assert set(got) == {"once", "mixed", "off"}
    mixed = got["mixed"]
    assert (mixed.plan_points, mixed.status, mixed.term) == (1.5, "active", 4)
    assert (mixed.task_name, mixed.team, mixed.slack_channel) == ("a;b", "t", "")
    assert (mixed.start_date, mixed.due_date) == ("2024-01-01", "2024-01-02")
    assert mixed.currency is None and mixed.has_growth_formula is None
    assert (got["off"].plan_points, got["off"].status) == (0.0, "inactive")
    assert len(got["once"].asDict()) == 16
    repeated = consolidate(df, CUSTOMER_CONSOLIDATION, F.col("ord"), only_repeated=True)
    assert sorted(r.task_id for r in repeated.collect()) == ["mixed", "off"]
