"""What one night leaves for the next, and what stops a night."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sprintmart import schemas, session
from sprintmart.functions.dates import epoch_ms_date
from sprintmart.operators.dedup import duplicate_rows, split_by_repetition, unique_rows
from sprintmart.operators.joins import left_lookup
from sprintmart.operators.scd2 import by_team, customer_spec, require_unique
from sprintmart.operators.skew import hot_keys, key_counts, salted_join, spread_over
from sprintmart.plans.tables import Tables
from sprintmart.queries import fixtures as fx
from sprintmart.queries import marts, relational
from sprintmart.queries.registry import Data
from sprintmart.sources.pages import page_records, read_pages
from sprintmart.sources.workspace import TreeRules, select_lists

SF = "/root/testdata/sf0.001"

PAGE = '{"results": [{"id": "1", "properties": {"squad_name": "Red"}}]}'


@pytest.mark.parametrize("bad", ['{"results": [{"id": "2", "prop', '{"status": "error", "message": "limit"}'])
def test_an_unreadable_page_stops_the_job_with_its_file(spark, tmp_path, bad):
    (tmp_path / "good.json").write_text(PAGE + "\n" + '{"results": []}\n')
    assert page_records(read_pages(spark, str(tmp_path), schemas.TEAM_PAGE)).count() == 1
    (tmp_path / "bad.json").write_text(bad + "\n")
    with pytest.raises(PySparkException, match="bad.json"):
        page_records(read_pages(spark, str(tmp_path), schemas.TEAM_PAGE)).collect()


def test_a_space_without_a_name_is_read(spark):
    tree = '{"spaces": [{"folders": [{"name": "f", "lists": [{"id": "1", "name": "l"}]}]}]}'
    rows = spark.createDataFrame([(tree,)], "t string").select(F.from_json("t", schemas.WORKSPACE).alias("w")).select("w.*")
    assert select_lists(rows, TreeRules(("Archive",), "Delivery", "Sprints", "x")).count() == 1


def test_at_most_one_row_of_a_key_is_active_after_each_night(spark):
    d = Data(spark, SF)
    root = session.scratch_dir(spark, "nights")
    for absent, run_ts in ((0, fx.RUN_TS), (1, marts.SECOND_TS), (0, marts.SECOND_TS + timedelta(days=14))):
        tables = Tables(spark, root, run_ts.strftime(marts.RUN_FORMAT))
        marts.publish_night(marts.landing(d, absent), tables, marts.settings(run_ts))
        for name, schema, key in (
            ("dim_customer", schemas.DIM_CUSTOMER, "service_name"),
            ("dim_squad", schemas.DIM_SQUAD, "email"),
            ("dim_task", schemas.DIM_TASK, "task_id"),
        ):
            active = tables.read_dimension(name, schema, including=True).filter(F.col("is_active_register"))
            active = active.filter(F.col(key).isNotNull())
            assert active.groupBy(key, "team").count().filter("count > 1").count() == 0
            assert active.count() > 0
    fact = tables.read_appended("fat_sprint_detail", schemas.FACT_SPRINT, including=True)
    stored = tables.read_stage("dim_sprint", schemas.DIM_SPRINT)
    assert fact.count() > 0 and fact.join(stored, F.col("sprint_uuid") == stored["uuid"], "left_anti").count() == 0


def test_two_staged_rows_of_one_key_stop_the_run_before_any_write(spark):
    row = {f.name: None for f in schemas.STG_CUSTOMER.fields} | {"customer": "c", "service_name": "s", "team": "a"}
    stage = lambda *teams: spark.createDataFrame([row | {"team": t} for t in teams], schemas.STG_CUSTOMER)
    require_unique(stage("a", "b", None), by_team(customer_spec()))
    with pytest.raises(ValueError, match="2 rows"):
        require_unique(stage("a", "b", "a"), by_team(customer_spec()))
    with pytest.raises(ValueError, match="2 rows"):
        require_unique(stage("a", "b"), customer_spec())


def test_files_without_a_commit_are_not_an_empty_table(spark, tmp_path, monkeypatch):
    one = Tables(spark, str(tmp_path), "20250101T000000")
    with monkeypatch.context() as stopped:
        stopped.setattr(Tables, "_commit", lambda *_, **__: None)
        one.write_appended(spark.range(3), "t")
    assert one.read_appended("t", spark.range(0).schema).count() == 0
    with pytest.raises(ValueError, match="none is committed"):
        Tables(spark, str(tmp_path), "20250201T000000").read_appended("t", spark.range(0).schema)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("__", "."): v for k, v in values.items()}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.scratch_dir(Session(spark__master=master), "x")
    assert session.scratch_dir(Session(spark__master="yarn", spark__checkpoint__dir="s3://b/c"), "x").startswith("s3://b/c/x-")
    assert session.scratch_dir(Session(spark__master="local[2]"), "x")


def test_epochs_of_any_number_type(spark):
    row = spark.range(1).select(
        *[epoch_ms_date(F.lit(1704067200000).cast(t)).cast("string").alias(t) for t in ("bigint", "double", "string")],
        epoch_ms_date(F.lit(float("nan"))).alias("nan"),
        epoch_ms_date(F.lit(-5.0)).alias("negative"),
    ).first()
    assert tuple(row) == ("2024-01-01", "2024-01-01", "2024-01-01", None, None)


def test_lookup_keys_of_unlike_types(spark):
    left = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "i int, k bigint")
    right = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "r double, v string")
    got = left_lookup(left, right, "k", "r", spread_by="i").orderBy("i").collect()
    assert [r.v for r in got] == ["a", None, None]
    with pytest.raises(TypeError, match="not alike"):
        left_lookup(left, right.withColumn("r", F.col("v")), "k", "r", spread_by="i")


def test_a_hot_key_in_one_partition_is_spread(spark):
    rows = spark.range(4000).select(F.lit(7).alias("k"), F.col("id").alias("v")).repartition(4, "k")
    hot = hot_keys(key_counts(rows, ["k"]), ["k"], 500)
    assert hot.first().salts == 8
    spread = rows.withColumn("s", spread_over(rows, F.lit(8))).groupBy("s").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 700
    names = spark.createDataFrame([(7, "seven")], "n int, name string")
    assert salted_join(rows, names, [("k", "n")], "left", hot).filter("name = 'seven'").count() == 4000


@pytest.mark.parametrize("hot_rows", [2, 3, 1_000_000])
def test_repetition_in_one_pass_equals_both_parts(spark, hot_rows):
    rows = spark.createDataFrame([(i % 7 if i % 3 else None, f"v{i}") for i in range(40)] + [(99, "once")], "k int, v string")
    both = split_by_repetition(rows, ["k"], hot_rows)
    split = {r.v for r in both.filter("repeated").collect()}
    assert split == {r.v for r in duplicate_rows(rows, ["k"], hot_rows).collect()}
    assert {r.v for r in unique_rows(rows, ["k"]).collect()} == {r.v for r in both.filter("not repeated").collect()} == {"once"}


def test_the_hot_lists_of_the_queries_are_not_empty(spark):
    d = Data(spark, SF)
    assert hot_keys(key_counts(d.orders, ["o_custkey"]), ["o_custkey"], relational.FEW).count() > 0
    assert hot_keys(key_counts(d.lineitem, ["l_orderkey"]), ["l_orderkey"], relational.FEW).count() > 0
    assert hot_keys(key_counts(d.events, ["user_id"]), ["user_id"], relational.BUSY).count() > 0
    assert hot_keys(key_counts(d.sql(relational.LINES), relational.LINE_KEY), relational.LINE_KEY, 3).count() > 0


def test_jobs_side_by_side(spark):
    counts = session.together(spark, lambda: spark.range(5).count(), lambda: spark.range(7).count())
    assert counts == [5, 7] and session.together(spark) == []
    ended = []

    def slow():
        ended.append(spark.range(3).count())

    def bad():
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        session.together(spark, bad, slow)
    assert ended == [3]
