from __future__ import annotations

import json
import os
import re
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from conftest import forced_skew, plan_of, tuples
from pyspark.sql import functions as F

from sprintmart import schemas
from sprintmart.operators import scd2
from sprintmart.operators.fact import fact_new_rows
from sprintmart.operators.history import TeamField, history_payload
from sprintmart.operators.sprints import CALENDAR_2025
from sprintmart.plans import staging
from sprintmart.plans.nightly import (
    DIMENSIONS,
    STAGES,
    Landing,
    Previous,
    Settings,
    publish_night,
    read_landing,
    run_night,
    stage_all,
)
from sprintmart.plans.tables import RUN_FORMAT, Tables
from sprintmart.queries import marts
from sprintmart.queries.registry import Data
from sprintmart.run import calendar_of, run, settings_of
from sprintmart.session import scratch_dir
from sprintmart.sources.pages import parse_pages
from sprintmart.sources.workspace import TreeRules

RUN_TS = datetime(2025, 4, 2, 22, 32, tzinfo=timezone.utc)


# --- fact ----------------------------------------------------------------------------------


def star(spark, tasks, loaded=()):
    task = spark.createDataFrame(
        tasks,
        "uuid string, sprint string, customer string, assignee_email string, status string,"
        " points_estimate bigint, points_estimated_rolled_up bigint, is_active_register boolean",
    )
    customer = spark.createDataFrame(
        [("c1", "Svc", True), ("c2", "Svc", True), ("c3", "Svc", False), ("c4", "Solo", True)],
        "uuid string, service_name string, is_active_register boolean",
    )
    squad = spark.createDataFrame(
        [("s1", "a@x", True), ("s2", "b@x", False)], "uuid string, email string, is_active_register boolean"
    )
    fact = spark.createDataFrame([(u,) for u in loaded], "task_uuid string")
    return task, CALENDAR_2025.dimension(spark), customer, squad, fact


def task(uuid, sprint="Sprint 7", customer="Solo", email="a@x", status="Done", points=3, active=True):
    return (uuid, sprint, customer, email, status, points, points, active)


def test_fact_rules(spark):
    tasks = [
        task("done"),
        task("complete", status="Complete"),
        task("off", active=False),
        task("nosprint", sprint="Sprint 77"),
        task("null sprint", sprint=None),
        task("nomember", email="b@x"),
        task("nocustomer", customer="?"),
        task("two", customer="Svc", status="To Do"),
        task("loaded"),
    ]
    got = fact_new_rows(*star(spark, tasks, ["loaded"]), 2025)
    rows = sorted((r.task_uuid, r.customer_uuid, r.points_estimate, r.points_done) for r in got.collect())
    assert rows == [("complete", "c4", 3, 0), ("done", "c4", 3, 3), ("two", "c1", 3, 0), ("two", "c2", 3, 0)]
    assert got.columns == schemas.FACT_SPRINT.fieldNames()
    assert len({r.uuid for r in got.collect()}) == 4


@pytest.mark.parametrize("null_aware", [True, False])
def test_second_load_is_empty(spark, null_aware):
    inputs = star(spark, [task("a"), task("b")])
    first = fact_new_rows(*inputs, 2025, null_aware=null_aware)
    fact = spark.createDataFrame(first.collect(), first.schema)
    assert fact.count() == 2
    assert fact_new_rows(*inputs[:4], fact, 2025, null_aware=null_aware).count() == 0


def test_null_in_the_fact_stops_the_null_aware_load(spark):
    inputs = star(spark, [task("a")], [None])
    assert fact_new_rows(*inputs, 2025).count() == 0
    assert fact_new_rows(*inputs, 2025, null_aware=False).count() == 1


def test_year_is_a_parameter(spark):
    assert fact_new_rows(*star(spark, [task("a")]), 2024).count() == 0


def test_a_hot_customer_and_member_are_split(spark):
    """A third of the tasks belongs to one service and half of them to one member."""
    key = F.col("id")
    text = lambda c: F.sha2(c.cast("string"), 256)
    tasks = spark.range(0, 40000, 1, 8).select(
        text(key).alias("uuid"),
        F.lit("Sprint 7").alias("sprint"),
        F.when(key % 3 == 0, "hot").otherwise(text(key % 5000)).alias("customer"),
        F.when(key % 2 == 0, "hot@x").otherwise(text(key % 3000)).alias("assignee_email"),
        F.lit("Done").alias("status"),
        F.lit(1).cast("bigint").alias("points_estimate"),
        F.lit(1).cast("bigint").alias("points_estimated_rolled_up"),
        F.lit(True).alias("is_active_register"),
    )

    def dim(n, name, hot):
        i = F.col("id")
        named = F.when(i == n, hot).otherwise(text(i)).alias(name)
        return spark.range(0, n + 1, 1, 8).select(text(i).alias("uuid"), named, F.lit(True).alias("is_active_register"))

    customers, squads = dim(5000, "service_name", "hot"), dim(3000, "email", "hot@x")
    loaded = spark.createDataFrame([], "task_uuid string")
    load = lambda: fact_new_rows(
        tasks, CALENDAR_2025.dimension(spark), customers, squads, loaded, 2025
    )
    assert forced_skew(spark, load).count("skew=true") >= 2
    assert load().count() == 40000


# --- payload -------------------------------------------------------------------------------

TEAM = TeamField("f-team", "Team", {"Red": 0, "Blue": 1})


def raw_task(i, user=None, status="to do", sprint=7, **extra):
    options = [{"id": None, "name": f"Sprint {n:02d}", "orderindex": n + 100} for n in range(1, 10)]
    fields = [{"id": "x", "name": "Custom Sprints", "type": "drop_down", "value": "0", "type_config": {"options": options}}]
    people = [] if user is None else [{"id": 5, "username": user, "email": f"{user.strip()}@x"}]
    doc = {"id": str(i), "name": f"T{i}", "status": {"status": status}, "assignees": people, "custom_fields": fields}
    return doc | extra, sprint


def tasks_frame(spark, *docs):
    text = spark.createDataFrame([(json.dumps(d), s) for d, s in docs], "j string, sprint_number bigint")
    return text.select(F.from_json("j", schemas.TASK).alias("t"), "sprint_number").select("t.*", "sprint_number")


def members(spark, *rows):
    return spark.createDataFrame(rows, "task_name string, team string")


def test_payload(spark):
    tasks = tasks_frame(
        spark,
        raw_task(1, " ann ", "complete", due_date="17", points=2.5, priority={"id": "3"}),
        raw_task(2, "bob", sprint=77),
        raw_task(3, sprint=None),
        raw_task(4, "cy"),
    )
    got = history_payload(tasks, members(spark, ("ann", "Blue"), ("ann", "Red"), (" bob", "Gold"), ("dee", "Red")), TEAM)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.task_id, []).append(r)
    assert sorted(len(v) for v in rows.values()) == [1, 1, 1, 2]
    one = rows["1"][0]
    assert (one.status, one.assignees, one.due_date, one.points, one.priority) == ("done", [5], "17", 2.5, "3")
    assert sorted(r.custom_fields[1].value for r in rows["1"]) == ["0", "1"]
    assert one.custom_fields[0].value == "107" and one.notify_all is False
    assert rows["2"][0].custom_fields[0].value == "0", "an unknown sprint keeps the value"
    assert rows["2"][0].custom_fields[1].value == "Unknown"
    three = rows["3"][0]
    assert (three.assignees, three.due_date, three.points, three.priority, three.description) == ([0], "0", 0.0, "0", "0")
    assert len(three.custom_fields) == 1 and len(rows["4"][0].custom_fields) == 1


# --- staging -------------------------------------------------------------------------------


def test_task_staging(spark):
    zone = "America/Sao_Paulo"
    late = str(int(datetime(2025, 4, 2, 1, tzinfo=timezone.utc).timestamp() * 1000))
    category = {"name": "Agile Category", "value": "0", "type_config": {"options": [{"name": "Customer task"}]}}
    tasks = tasks_frame(
        spark,
        raw_task(1, "ann", "in-progress", start_date=late, points=2.5, priority={"priority": "low"}, date_closed="x"),
        raw_task(2, "ann", custom_fields=[category]),
        raw_task(3, sprint=None),
    )
    squads = spark.createDataFrame([("ann@x", "Red"), ("ann@x", "Blue"), (None, "Null")], "email string, team string")
    got = staging.stg_task(tasks, squads, RUN_TS, zone)
    assert got.schema.simpleString() == schemas.STG_TASK.simpleString()
    rows = {(r.task_id, r.team): r for r in got.collect()}
    assert set(rows) == {("1", "Red"), ("1", "Blue"), ("2", "Customer"), ("3", None)}
    one = rows["1", "Red"]
    assert (one.status, one.priority, one.points_estimate, one.sprint) == ("IN-PROGRESS", "LOW", 2, "Sprint 7")
    assert one.start_date == date(2025, 4, 1) and one.date_closed is None
    assert one.customer == "Unknown Customer" and one.import_date == date(2025, 4, 2)
    assert rows["3", None].sprint is None and rows["3", None].email is None
    assert got.count() == 5


def test_clean_text_and_project(spark):
    df = spark.createDataFrame([(" a\xa0", "None", 1)], "x string, y string, n int")
    assert tuple(staging.clean_text(df).first()) == ("a", None, 1)
    assert staging.project(df, [("p", "x"), ("q", "x")]).columns == ["p", "q"]
    changed = staging.overwrite_when(df, F.lit(None).cast("boolean"), "n", F.lit(9))
    assert changed.first().n == 1


# --- published tables and the night --------------------------------------------------------


def test_a_failed_refresh_leaves_the_old_stage(spark, tmp_path):
    first, second = (Tables(spark, str(tmp_path), r) for r in ("20250101T000000", "20250102T000000"))
    schema = spark.range(0).schema
    assert first.read_stage("stg", schema).count() == 0
    first.write_stage(spark.range(5), "stg")
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        second.write_stage(bad, "stg")
    assert second.read_stage("stg", schema).count() == 5
    # Written, but not yet switched to; then both stages at once.
    second.write_stage(spark.range(7), "stg", commit=False)
    assert second.read_stage("stg", schema).count() == 5
    second.commit_stages(["stg"])
    assert second.read_stage("stg", schema).count() == 7
    assert first.read_stage("stg", schema).count() == 5
    assert second.superseded_stages("stg") == [first.path("stg", first.run)]


def landing(spark, sprint="Sprint 7 - 2025", status="done"):
    def pages(schema, *docs):
        return parse_pages(spark.createDataFrame([(json.dumps(x),) for x in docs], "j string"), "j", schema)

    member = {"id": "m1", "properties": {"member_name": " ann", "member_email": "ann@x", "member_status": "Active"}}
    customer = {"id": "c1", "createdAt": "2024-01-01T00:00:00Z", "properties": {"customer_name": "Corp"}}
    bought = {"id": "p1", "properties": {"hs_object_id": "p1", "service_name": "Svc", "service_status": "active"}}
    hidden = {"id": "p2", "properties": {"hs_object_id": "p2", "service_name": "Internal lab"}}
    option = {"name": "Customer", "value": "0", "type_config": {"options": [{"name": "Svc"}]}}
    listed = lambda doc: doc | {"list": {"name": sprint}}
    tasks = [listed(raw_task(i, "ann", status, points=i)[0]) for i in (1, 2)]
    for t in tasks:
        t["custom_fields"] = [*t["custom_fields"], option]
    folder = {"name": "Sprints", "lists": [{"id": "l7", "name": sprint}, {"id": "l8", "name": "Sprint 8 - 2025"}]}
    return Landing(
        members=pages(schemas.MEMBER_PAGE, {"results": [member]}),
        member_teams=pages(schemas.ASSOCIATION_PAGE, {"record_id": "m1", "results": [{"id": "t1"}]}),
        teams=pages(schemas.TEAM_PAGE, {"results": [{"id": "t1", "properties": {"squad_name": "Red"}}]}),
        customers=pages(schemas.CUSTOMER_PAGE, {"results": [customer]}),
        customer_purchases=pages(
            schemas.ASSOCIATION_PAGE, {"record_id": "c1", "results": [{"id": "p1"}, {"id": "p2"}]}
        ),
        purchases=pages(schemas.PURCHASE_PAGE, {"results": [bought, hidden]}),
        purchase_teams=pages(schemas.ASSOCIATION_PAGE, {"record_id": "p1", "results": [{"id": "t1"}]}),
        workspace=pages(schemas.WORKSPACE, {"spaces": [{"name": "Main", "folders": [folder]}]}),
        task_pages=pages(schemas.TASK_PAGE, {"list_id": "l7", "tasks": tasks}, {"list_id": "l8", "tasks": tasks}),
    )


def settings(run_ts=RUN_TS):
    return Settings(
        run_ts=run_ts,
        today=run_ts.date(),
        calendar=CALENDAR_2025,
        rules=TreeRules((), "Main", "Sprints", "Sprint 7 - 2025"),
        team_field=TEAM,
        excluded_service="internal",
    )


def tables(spark, root, run_ts):
    return Tables(spark, str(root), run_ts.strftime(RUN_FORMAT))


def test_three_nights(spark, tmp_path):
    first = tables(spark, tmp_path, RUN_TS)
    publish_night(landing(spark, status="to do"), first, settings())
    dim = first.read_dimension("dim_task", schemas.DIM_TASK, including=True)
    assert sorted((r.task_id, r.status) for r in dim.collect()) == [("1", "To Do"), ("2", "To Do")]
    assert dim.schema.simpleString() == schemas.DIM_TASK.simpleString()
    customers = first.read_dimension("dim_customer", schemas.DIM_CUSTOMER, including=True)
    assert [r.service_name for r in customers.collect()] == ["Svc"]
    facts = first.read_appended("fat_sprint_detail", schemas.FACT_SPRINT, including=True)
    assert sorted((r.points_estimate, r.points_done) for r in facts.collect()) == [(1, 0), (2, 0)]

    later = RUN_TS + timedelta(days=1)
    second = tables(spark, tmp_path, later)
    for _ in range(2):  # a repeated run leaves the same result
        publish_night(landing(spark), second, settings(later))
        dim = second.read_dimension("dim_task", schemas.DIM_TASK, including=True)
        flags = sorted((r.task_id, r.status, r.is_active_register) for r in dim.collect())
        assert flags == [("1", "Done", True), ("1", "To Do", False), ("2", "Done", True), ("2", "To Do", False)]
        facts = second.read_appended("fat_sprint_detail", schemas.FACT_SPRINT, including=True)
        assert sorted(r.points_done for r in facts.collect()) == [0, 0, 1, 2]
    payload = spark.read.json(second.path("history_payload", second.run))
    assert sorted(r.status for r in payload.collect()) == ["done", "done"]

    third = tables(spark, tmp_path, later + timedelta(days=1))
    assert third.read_dimension("dim_task", schemas.DIM_TASK).count() == 4
    assert third.committed("dim_task") == [first.run, second.run]
    assert len(third.expired_stages(later + timedelta(days=1, seconds=-1))) > 0
    assert third.expired_stages(RUN_TS) == []
    folders = third.superseded("dim_task")
    assert folders and all(f.startswith(f"{first.path('dim_task', first.run)}/is_active_register=true/bucket=") for f in folders)
    # Retention: what the first day left goes, the tables stay as they are.
    now = later + timedelta(days=2)
    before = third.read_dimension("dim_task", schemas.DIM_TASK).count()
    old = third.expired_stages(now, days=1)
    dropped = third.drop_expired(now, 1, DIMENSIONS, STAGES)
    assert set(old) < set(dropped) and set(folders) <= set(dropped)
    assert not any(os.path.exists(f) for f in dropped)
    assert third.expired_stages(now, days=1) == [] and third.drop_expired(now, 1) == []
    assert third.read_dimension("dim_task", schemas.DIM_TASK).count() == before
    assert third.read_stage("stg_task", schemas.STG_TASK).count() == 2


def test_a_night_drops_what_is_older_than_it_keeps(spark, tmp_path):
    first, later = tables(spark, tmp_path, RUN_TS), RUN_TS + timedelta(days=2)
    publish_night(landing(spark, status="to do"), first, settings())
    assert any(os.path.isdir(p) for p in first.expired_stages(later))
    second = tables(spark, tmp_path, later)
    publish_night(landing(spark), second, replace(settings(later), keep_days=1))
    assert not os.path.exists(first.path("_delta/dim_task_tags", first.run))
    assert os.path.exists(second.path("_delta/dim_task_tags", second.run))
    assert second.read_dimension("dim_task", schemas.DIM_TASK, including=True).count() == 4


def files_below(folder) -> dict[str, int]:
    return {
        os.path.join(base, name): os.stat(os.path.join(base, name)).st_mtime_ns
        for base, _, names in os.walk(folder) for name in names if name.endswith(".parquet")
    }


def task_rows(spark, schema, ids, **values):
    rows = [tuple(({"task_id": str(i), "task_name": f"t{i}"} | values).get(f.name) for f in schema.fields) for i in ids]
    return spark.createDataFrame(rows, schema)


def bucketed(spark, tmp_path, n=400, buckets=16):
    first = Tables(spark, str(tmp_path), "20250101T000000", buckets)
    old = {"is_active_register": True, "import_date": date(2025, 1, 1)}
    dim = task_rows(spark, schemas.DIM_TASK, range(n), **old).withColumn("uuid", F.md5("task_id"))
    first.write_dimension(dim, "dim_task", "task_id")
    return first, Tables(spark, str(tmp_path), "20250102T000000", buckets)


def merge_into(tables, stg):
    before = tables.read_dimension("dim_task", schemas.DIM_TASK)
    merged = scd2.scd2_parts(before, stg, scd2.task_spec(), stage=tables.stage)
    return merged, tables.write_merge(merged, "dim_task", "task_id", schemas.DIM_TASK)


def staged_tasks(spark, ids):
    return task_rows(spark, schemas.STG_TASK, ids, import_date=date(2025, 1, 2), import_date_time=RUN_TS)


def test_a_merge_rewrites_the_buckets_it_touches(spark, tmp_path):
    first, second = bucketed(spark, tmp_path)
    before = files_below(first.path("dim_task", first.run))
    assert len(first._layout("dim_task", True)[0]) == 16
    _, rows = merge_into(second, staged_tasks(spark, [3, 4, 1000]))
    layout = second._layout("dim_task", True)[0]
    rewritten = [b for b, path in layout.items() if second.run in path]
    assert 1 <= len(rewritten) <= 3
    assert files_below(first.path("dim_task", first.run)) == before
    after = second.read_dimension("dim_task", schemas.DIM_TASK, including=True).collect()
    assert sorted(r.task_id for r in after if r.is_active_register) == sorted(map(str, [*range(400), 1000]))
    assert sorted(r.task_id for r in after if not r.is_active_register) == ["3", "4"]
    assert sorted(r.uuid for r in rows.collect()) == sorted(r.uuid for r in after)
    # A third run sees the buckets of both; one in another number of buckets rewrites all of them.
    third = Tables(spark, str(tmp_path), "20250103T000000", 4)
    merge_into(third, staged_tasks(spark, [5]).withColumn("import_date", F.lit(date(2025, 1, 3))))
    assert len(third._layout("dim_task", True)[0]) == 4
    assert third.read_active("dim_task", schemas.DIM_TASK, including=True).count() == 401
    assert third.read_dimension("dim_task", schemas.DIM_TASK, including=True).count() == 404


def test_a_bucket_left_empty_is_empty(spark, tmp_path):
    first, second = bucketed(spark, tmp_path, n=1)
    (bucket,) = first._layout("dim_task", True)[0]
    none = second.read_dimension("dim_task", schemas.DIM_TASK).limit(0)
    second.write_dimension(none, "dim_task", "task_id", {bucket})
    assert second.read_active("dim_task", schemas.DIM_TASK, including=True).count() == 0
    assert second.read_active("dim_task", schemas.DIM_TASK).count() == 1
    with pytest.raises(ValueError, match="not to be rewritten"):
        second.write_dimension(task_rows(spark, schemas.DIM_TASK, range(40), is_active_register=True), "dim_task", "task_id", {bucket})


def test_a_merge_compares_the_active_part_once_by_its_keys(spark, tmp_path):
    first, second = bucketed(spark, tmp_path)
    before = second.read_dimension("dim_task", schemas.DIM_TASK)
    plans: dict[str, tuple] = {}

    def stage(df, name):
        plans[name] = df.inputFiles(), df._jdf.queryExecution().executedPlan().toString()
        return second.stage(df, name)

    files = re.compile(r"is_active_register=true")
    merged = scd2.scd2_parts(before, staged_tasks(spark, [3, 1000]), scd2.task_spec(), stage=stage)
    # The tags read the keys alone, and no other step reads the active part: new rows are looked up in the history.
    assert {name for name, (found, _) in plans.items() if any(files.search(f) for f in found)} == {"dim_task_tags", "dim_task_new"}
    assert re.search(r"PartitionFilters: \[[^\]]*NOT [^\]]*is_active_register", plans["dim_task_new"][1])
    physical = second.read_dimension("dim_task", schemas.DIM_TASK)
    tags = scd2.tag_active(physical.filter("is_active_register"), staged_tasks(spark, [3]), scd2.task_spec())
    read = re.search(r"ReadSchema: struct<([^>]*)>", tags._jdf.queryExecution().executedPlan().toString()).group(1)
    assert {c.partition(":")[0] for c in read.split(",")} == {"uuid", "task_id", "task_name", "import_date"}
    assert {r.task_id for r in merged.new.collect()} == {"1000"}


SPEC = {
    "calendar": {"first_day": "2025-01-07", "sprints": 25},
    "sprint_space": "Main",
    "sprint_folder": "Sprints",
    "team_field": {"id": "f", "name": "Team", "options": {"Red": 0}},
    "tz": "America/Sao_Paulo",
}


def test_settings_file():
    cfg = settings_of(SPEC, RUN_TS)
    assert cfg.calendar == CALENDAR_2025 and cfg.sprint_year == 2025
    assert cfg.tree_rules.sprint_list == "Sprint 7 - 2025"
    assert settings_of(SPEC, datetime(2026, 6, 1, tzinfo=timezone.utc)).tree_rules.sprint_list is None
    late = datetime(2025, 4, 1, 2, 0, tzinfo=timezone.utc)
    assert settings_of(SPEC, late).today == date(2025, 3, 31)
    odd = {"windows": [[1, "2025-01-07", "2025-01-09", 2025], [2, "2025-02-01", "2025-02-03", 2025]]}
    assert calendar_of(odd).current(date(2025, 2, 2)).label == "Sprint 2"


def test_landed_files_are_read(spark, tmp_path):
    fields = [
        {"name": "Reviewer", "value": [{"username": "rita"}, {"username": "tom"}]},
        {"name": "Customer", "value": 1, "type_config": {"options": [{"name": "x"}, {"name": "Svc"}]}},
        {"name": "Quality Score", "value": "8"},
    ]
    docs = {
        "members": {"results": [{"id": "m1", "properties": {"member_email": "a@x"}}]},
        "member_teams": {"record_id": "m1", "results": []},
        "teams": {"results": []},
        "customers": {"results": []},
        "customer_purchases": {"record_id": "c", "results": []},
        "purchases": {"results": []},
        "purchase_teams": {"record_id": "p", "results": []},
        "workspace": {"spaces": [{"name": "Main", "folders": [{"name": "Sprints", "lists": [{"id": "l", "name": "Sprint 7 - 2025"}]}]}]},
        "task_pages": {"list_id": "l", "tasks": [{"id": "1", "name": "T", "list": {"name": "Sprint 7 - 2025"}, "custom_fields": fields}]},
    }
    for name, doc in docs.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "page.json").write_text(json.dumps(doc))
    staged = stage_all(read_landing(spark, str(tmp_path)), settings())
    row = staged.tasks.first()
    assert (row.reviewer, row.customer, row.quality_score, row.sprint) == ("rita", "Svc", "8", "Sprint 7")
    assert staged.squads.count() == 1 and staged.customers.count() == 0
    written = run(spark, str(tmp_path), str(tmp_path / "mart"), SPEC, RUN_TS)
    dim = written.read_dimension("dim_task", schemas.DIM_TASK, including=True)
    assert [(r.task_id, r.reviewer, r.quality_score) for r in dim.collect()] == [("1", "rita", 8)]


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_an_unfinished_run_is_not_read(spark, tmp_path, monkeypatch):
    old = tables(spark, tmp_path, RUN_TS)
    publish_night(landing(spark), old, settings())
    broken = tables(spark, tmp_path, RUN_TS + timedelta(hours=1))
    rows = old.read_dimension("dim_squad", schemas.DIM_SQUAD, including=True)
    with monkeypatch.context() as stopped:
        stopped.setattr(Tables, "_commit", lambda *_, **__: None)
        broken.write_dimension(rows.withColumn("is_active_register", F.lit(False)), "dim_squad")
    after = tables(spark, tmp_path, RUN_TS + timedelta(days=1))
    got = after.read_dimension("dim_squad", schemas.DIM_SQUAD).collect()
    assert [r.is_active_register for r in got] == [True]


def test_the_session_must_run_in_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            publish_night(landing(spark), tables(spark, tmp_path, RUN_TS), settings())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_night_outside_every_sprint_is_empty(spark):
    cfg = settings(datetime(2026, 6, 1, tzinfo=timezone.utc))
    empty = lambda s: spark.createDataFrame([], s)
    previous = Previous(*map(empty, (schemas.DIM_CUSTOMER, schemas.DIM_SQUAD, schemas.DIM_TASK, schemas.FACT_SPRINT)))
    night = run_night(landing(spark), previous, cfg)
    assert night.fact_rows.count() == 0 and night.payload.count() == 0
    assert night.staged.customers.count() == 1
    assert "EvalPython" not in plan_of(night.fact_rows)


def test_consolidated_staging_has_one_row_per_customer(spark):
    cfg = settings()
    pages = landing(spark)
    plain = stage_all(pages, cfg).customers
    assert tuples(plain.select("task_id", "service_name", "team")) == [("c1", "Svc", "Red")]
    merged = staging.stg_customer(
        spark.createDataFrame(
            [("c1", "Corp", "5", "active", "A", "10.005"), ("c1", "Corp", "7", "off", "B", "1"), (None, "N", None, None, "C", None), (None, "N", None, None, "C", None)],
            "id string, customer_name string, sprint_points_plan string, service_status string, service_name string, mrr string",
        ).selectExpr(
            "*", "'brl' service_currency", "null service_start_date", "null service_end_date", "null service_due_date",
            "'true' growth_formula_implemented", "null slack_channel", "null squad_name", "'1' subscription_crm_id",
            "'2024-01-01T00:00:00Z' createdAt", "null updatedAt",
        ).selectExpr(*[
            "id", "customer_name", "sprint_points_plan", "service_status", "service_name", "mrr", "service_currency",
            "string(service_start_date) service_start_date", "string(service_end_date) service_end_date",
            "string(service_due_date) service_due_date", "growth_formula_implemented",
            "string(slack_channel) slack_channel", "string(squad_name) squad_name", "subscription_crm_id",
            "createdAt", "string(updatedAt) updatedAt",
        ]),
        RUN_TS,
        consolidate=True,
    )
    rows = sorted(((r.task_id or "", r.plan_points, r.status, r.service_name) for r in merged.collect()), key=repr)
    assert rows == [("", 0, None, "C"), ("", 0, None, "C"), ("c1", 5, "active", None)]


def test_rejected_values_are_counted_by_the_write(spark, tmp_path):
    root = tables(spark, tmp_path, RUN_TS)
    landed = landing(spark)
    bad = landed.members.select(
        F.transform("results", lambda r: r.withField("properties.capacity_points", F.lit("a few"))
                    .withField("properties.start_date", F.lit("None")).withField("properties.hs_createdate", F.lit("x"))).alias("results")
    )
    night = publish_night(replace(landed, members=bad), root, settings())
    rows = root.read_stage("stg_rejects", spark.createDataFrame([], "stage string, key string, field string, raw string").schema)
    assert sorted(map(tuple, rows.collect())) == [
        ("stg_squad", "m1", "capacity_points", "a few"), ("stg_squad", "m1", "date_created", "x")
    ]
    counts = {(s, f): n for s, f, n in night.staged.rejected_counts() if n}
    assert counts == {("stg_squad", "capacity_points"): 1, ("stg_squad", "date_created"): 1}
    stored = root.read_appended("reject_counts", spark.createDataFrame([], "stage string, field string, n long").schema, including=True)
    assert stored.count() == sum(map(len, staging.CHECKED.values()))
    assert root.read_stage("stg_squad", schemas.STG_SQUAD).columns == schemas.STG_SQUAD.fieldNames()
    with pytest.raises(ValueError, match="not merged"):
        staging.stg_customer(spark.createDataFrame([], "id string"), RUN_TS, consolidate=True, rejects=True)


def test_a_bucketed_fact_is_not_shuffled(spark):
    d = Data(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks, sprints, customers, squads, loaded = marts.bucketed_star(d)
        plan = fact_new_rows(tasks, sprints, customers, squads, loaded, 1995)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    # Tasks are shuffled for the joins behind, by service and member, but not by task; nor are the fact's keys.
    assert not re.search(r"Exchange hashpartitioning\((task_uuid|uuid|_loaded|_k0)#", plan)
