"""The merges against a step-by-step replay in plain Python, and their invariants."""

from __future__ import annotations

import random
import re
from datetime import date, datetime

import pytest
from conftest import forced_skew, plan_of, tuples
from pyspark.sql import functions as F

from sprintmart import schemas
from sprintmart.operators import scd2

OLD, NEW = date(2025, 1, 1), date(2025, 1, 15)
STAMP = datetime(2025, 1, 15, 22, 32)


def fill(schema, **values):
    return tuple(values.get(f.name) for f in schema.fields)


def customer_stage(**v):
    return fill(schemas.STG_CUSTOMER, **({"import_date": NEW, "import_date_time": STAMP, "status": "on hold"} | v))


def customer_dim(**v):
    base = {"import_date": OLD, "import_date_time": STAMP, "is_active_register": True, "status": "On Hold"}
    return fill(schemas.DIM_CUSTOMER, **(base | v))


def task_stage(**v):
    base = {"import_date": NEW, "import_date_time": STAMP, "status": "IN-PROGRESS"}
    return fill(schemas.STG_TASK, **(base | v))


def task_dim(**v):
    base = {"import_date": OLD, "import_date_time": STAMP, "is_active_register": True}
    return fill(schemas.DIM_TASK, **(base | v))


def frames(spark, dim, stg, kind="customer"):
    dims, stages = {
        "customer": (schemas.DIM_CUSTOMER, schemas.STG_CUSTOMER),
        "task": (schemas.DIM_TASK, schemas.STG_TASK),
    }[kind]
    return spark.createDataFrame(dim, dims), spark.createDataFrame(stg, stages)


def replay(dim, stg, spec):
    """The same merge one statement at a time; dimension rows as (uuid, key columns, flag)."""
    sk, dk = spec.match_key
    nsk, ndk = spec.new_key
    dim = [dict(r) for r in dim]
    need = [
        (d, s)
        for s in stg
        for d in dim
        if s[spec.stg_required] is not None
        and (spec.dim_required is None or d[spec.dim_required] is not None)
        and s[sk] is not None
        and s[sk] == d[dk]
        and d["is_active_register"]
        and None not in (s["import_date"], d["import_date"])
        and s["import_date"] != d["import_date"]
    ]
    for d, _ in need:
        d["is_active_register"] = False
    insert = lambda s: {
        "uuid": None, "is_active_register": True, "import_date": s["import_date"],
        **{c: s.get(src) for c, src in spec_columns(spec).items()},
    }
    if spec.reinsert_changed_only:
        fresh = [insert(s) for _, s in need]
    else:
        fresh = [insert(s) for d, _ in need for s in stg if s[sk] == d[dk]]
    dim += fresh
    new = [
        insert(s)
        for s in stg
        if s[spec.new_required] is not None
        and not any(d[ndk] == s[nsk] and s[nsk] is not None and d[spec.new_probe] is not None for d in dim)
    ]
    return dim + new


def spec_columns(spec):
    if spec.table == "dim_customer":
        return {"external_id": "task_id", "service_name": "service_name", "customer": "customer"}
    return {"task_id": "task_id", "task_name": "task_name"}


def shown(rows, spec):
    columns = [*spec_columns(spec), "is_active_register", "import_date"]
    get = lambda r, c: r[c]
    return sorted((tuple(get(r, c) for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_customer_merge_equals_the_replay(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(40)]
    rng.shuffle(names)
    stage = [
        customer_stage(
            task_id=rng.choice([None, *[str(i) for i in range(25)]]),
            service_name=name if rng.random() < 0.9 else None,
            customer=rng.choice([None, "c", "c", "c"]),
            import_date=rng.choice([OLD, NEW, NEW, None]),
        )
        for name in names[:30]
    ]
    dim = [
        customer_dim(
            uuid=f"u{i}",
            external_id=rng.choice([None, *[str(i) for i in range(25)]]),
            service_name=rng.choice([None, *names]),
            is_active_register=rng.random() < 0.6,
            import_date=rng.choice([OLD, OLD, NEW, None]),
        )
        for i in range(40)
    ]
    d, s = frames(spark, dim, stage)
    spec = scd2.customer_spec()
    got = scd2.scd2_merge(d, s, spec).collect()
    as_dicts = lambda rows, schema: [dict(zip(schema.fieldNames(), r)) for r in rows]
    want = replay(as_dicts(dim, schemas.DIM_CUSTOMER), as_dicts(stage, schemas.STG_CUSTOMER), spec)
    assert shown(got, spec) == shown(want, spec)
    assert len({r.uuid for r in got}) == len(got)


@pytest.mark.parametrize("seed", range(3))
def test_task_merge_equals_the_replay(spark, seed):
    rng = random.Random(100 + seed)
    ids = [str(i) for i in range(50)]
    rng.shuffle(ids)
    stage = [
        task_stage(
            task_id=i if rng.random() < 0.95 else None,
            task_name=rng.choice([None, "t", "t"]),
            import_date=rng.choice([OLD, NEW, NEW, None]),
        )
        for i in ids[:35]
    ]
    dim = [
        task_dim(
            uuid=f"u{n}",
            task_id=rng.choice(ids),
            task_name=rng.choice([None, "t", "t"]),
            is_active_register=rng.random() < 0.6,
            import_date=rng.choice([OLD, NEW, None]),
        )
        for n in range(45)
    ]
    d, s = frames(spark, dim, stage, "task")
    spec = scd2.task_spec()
    got = scd2.scd2_merge(d, s, spec).collect()
    as_dicts = lambda rows, schema: [dict(zip(schema.fieldNames(), r)) for r in rows]
    want = replay(as_dicts(dim, schemas.DIM_TASK), as_dicts(stage, schemas.STG_TASK), spec)
    assert shown(got, spec) == shown(want, spec)


def test_named_cases(spark):
    dim = [
        customer_dim(uuid="same", external_id="1", service_name="same", import_date=NEW),
        customer_dim(uuid="moved", external_id="2", service_name="moved"),
        customer_dim(uuid="only", external_id="3", service_name="only"),
        customer_dim(uuid="off", external_id="4", service_name="off", is_active_register=False),
        customer_dim(uuid="nodate", external_id="5", service_name="nodate", import_date=None),
        customer_dim(uuid="renamed", external_id="6", service_name="before"),
    ]
    stage = [
        customer_stage(task_id="1", service_name="same", customer="c"),
        customer_stage(task_id="2", service_name="moved", customer="c"),
        customer_stage(task_id="4", service_name="off", customer="c"),
        customer_stage(task_id="5", service_name="nodate", customer="c"),
        customer_stage(task_id="6", service_name="after", customer="c"),
        customer_stage(task_id="7", service_name="fresh", customer=None),
        customer_stage(task_id="8", service_name=None, customer="c"),
    ]
    d, s = frames(spark, dim, stage)
    got = {(r.service_name, r.is_active_register): r for r in scd2.scd2_merge(d, s, scd2.customer_spec()).collect()}
    assert ("moved", False) in got and ("moved", True) in got
    assert got["moved", True].status == "On Hold" and got["moved", True].has_growth_formula is False
    assert ("same", False) not in got and ("nodate", False) not in got
    assert ("off", True) not in got, "a key known only as inactive is not new"
    assert ("after", True) not in got, "a known customer's other service is neither changed nor new"
    assert ("fresh", True) in got and (None, True) not in got
    wide = scd2.matching_new_key(scd2.customer_spec())
    again = scd2.scd2_merge(d, s, wide).collect()
    assert "after" in {r.service_name for r in again}


def test_rerun_changes_nothing(spark):
    dim = [customer_dim(uuid=f"u{i}", external_id=str(i), service_name=f"s{i}") for i in range(6)]
    stage = [customer_stage(task_id=str(i), service_name=f"s{i}", customer="c") for i in range(3, 9)]
    d, s = frames(spark, dim, stage)
    spec = scd2.customer_spec()
    once = scd2.scd2_merge(d, s, spec)
    first = tuples(once)
    stored = spark.createDataFrame(once.collect(), once.schema)
    assert tuples(scd2.scd2_merge(stored, s, spec)) == first
    active = [r for r in once.collect() if r.is_active_register]
    assert len({r.service_name for r in active}) == len(active) == 9
    assert len(first) == 6 + 3 + 3


def test_duplicate_staged_keys(spark):
    dim = [customer_dim(uuid="u", external_id="1", service_name="a")]
    twice = [
        customer_stage(task_id="1", service_name="a", customer="old", date_updated=date(2025, 1, 2)),
        customer_stage(task_id="1", service_name="a", customer="late", date_updated=date(2025, 1, 3)),
        customer_stage(task_id="9", service_name="n", customer="x"),
        customer_stage(task_id="9", service_name="n", customer="x", team="t"),
    ]
    d, s = frames(spark, dim, twice)
    spec = scd2.customer_spec()
    with pytest.raises(Exception, match="several staged rows for key a"):
        scd2.scd2_merge(d, s, spec).collect()
    # Copies of a key the dimension does not hold are all inserted.
    both = scd2.scd2_merge(d.limit(0), s, spec).collect()
    assert len(both) == 4
    latest = scd2.scd2_merge(d, s, spec, duplicates="latest").collect()
    assert sorted(r.customer or "" for r in latest if r.is_active_register) == ["late", "x"]
    with pytest.raises(ValueError):
        scd2.scd2_merge(d, s, spec, duplicates="any")


def test_two_active_rows_of_one_key_are_both_replaced(spark):
    dim = [customer_dim(uuid=u, external_id="1", service_name="a") for u in ("u1", "u2")]
    d, s = frames(spark, dim, [customer_stage(task_id="1", service_name="a", customer="c")])
    got = scd2.scd2_merge(d, s, scd2.customer_spec()).collect()
    assert sorted(r.is_active_register for r in got) == [False, False, True, True]
    assert len({r.uuid for r in got}) == 4


def test_change_by_attributes(spark):
    dim = [
        customer_dim(uuid="u1", external_id="1", service_name="a", customer="c", plan_points=5),
        customer_dim(uuid="u2", external_id="2", service_name="b", customer="c", plan_points=5),
    ]
    stage = [
        customer_stage(task_id="1", service_name="a", customer="c", plan_points=5),
        customer_stage(task_id="2", service_name="b", customer="c", plan_points=None),
    ]
    d, s = frames(spark, dim, stage)
    got = scd2.scd2_merge(d, s, scd2.customer_spec(), change="attributes").collect()
    assert sorted(r.uuid for r in got if not r.is_active_register) == ["u2"]
    assert len(got) == 3
    with pytest.raises(ValueError):
        scd2.scd2_merge(d, s, scd2.customer_spec(), change="size")


def test_empty_inputs(spark):
    d, s = frames(spark, [], [])
    assert scd2.scd2_merge(d, s, scd2.customer_spec()).count() == 0
    one = spark.createDataFrame([customer_dim(uuid="u", external_id="1", service_name="a")], schemas.DIM_CUSTOMER)
    assert scd2.scd2_merge(one, s, scd2.customer_spec()).count() == 1


def test_squad_dates_and_names(spark):
    stage = fill(
        schemas.STG_SQUAD, task_id="1", task_name=" Ann ", email="a@x", status="ON THE TEAM",
        start_date="03/04/2024", due_date="None", import_date=NEW, import_date_time=STAMP,
    )
    dim = spark.createDataFrame([], schemas.DIM_SQUAD)
    got = scd2.scd2_merge(dim, spark.createDataFrame([stage], schemas.STG_SQUAD), scd2.squad_spec()).first()
    assert (got.member_name, got.status, got.start_date, got.due_date) == ("Ann", "On The Team", date(2024, 4, 3), None)
    assert got.asDict().keys() == set(schemas.DIM_SQUAD.fieldNames())


def test_plans_have_no_python_and_no_cross_join(spark):
    d, s = frames(spark, [customer_dim(uuid="u", service_name="a")], [customer_stage(service_name="b")])
    plan = plan_of(scd2.scd2_merge(d, s, scd2.customer_spec()))
    assert "LeftAnti" in plan
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_hot_staged_key_is_reduced_before_the_shuffle(spark):
    rows = [customer_stage(task_id=str(i), service_name="hot" if i % 3 == 0 else f"s{i}", customer="c") for i in range(300)]
    s = spark.createDataFrame(rows, schemas.STG_CUSTOMER).repartition(4)
    got = scd2.latest_per_key(s, "service_name", ["date_updated"])
    assert got.count() == 201
    assert "Window" not in plan_of(got) and "partial_max_by" in plan_of(got)
    assert got.filter(F.col("service_name") == "hot").count() == 1


def test_a_hot_dimension_key_is_split(spark):
    """A third of the active rows carries one service name, another part none."""
    i = F.col("id")
    name = F.when(i % 3 == 0, "hot").when(i % 5 != 0, F.sha2((i % 4000).cast("string"), 256))
    given = {"uuid": F.md5(i.cast("string")), "service_name": name, "is_active_register": F.lit(True)}
    given |= {"external_id": F.sha2(i.cast("string"), 256), "import_date": F.lit(OLD)}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.DIM_CUSTOMER.fields]
    dim = spark.range(0, 40000, 1, 8).select(*columns)
    given = {"task_id": F.lit("x"), "service_name": F.when(i == 0, "hot").otherwise(F.sha2(i.cast("string"), 256))}
    given |= {"customer": F.lit("c"), "import_date": F.lit(NEW), "import_date_time": F.lit(STAMP)}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.STG_CUSTOMER.fields]
    stg = spark.range(0, 4000, 1, 8).select(*columns)
    flagged = lambda: scd2.flag_changed(dim, stg, scd2.customer_spec())
    assert "skew=true" in forced_skew(spark, flagged)
    assert flagged().filter("_changed and service_name = 'hot'").count() == 13334
    assert flagged().count() == 40000


@pytest.mark.parametrize("hot_side", ["seen", "staged"])
def test_the_search_for_new_rows_is_split(spark, hot_side):
    """A third of the dimension, or of the stage, carries one key."""
    i = F.col("id")
    text = lambda c: F.sha2(c.cast("string"), 256)

    def key(side, others):
        return F.when((i % 3 == 0) & F.lit(hot_side == side), text(F.lit(-1))).otherwise(text(i % others))

    seen = spark.range(0, 60000, 1, 8).select(key("seen", 64).alias("_have"))
    given = {"task_id": key("staged", 9000), "service_name": text(i)}
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.STG_CUSTOMER.fields]
    stg = spark.range(0, 30000, 1, 8).select(*columns).filter("task_id is not null")
    search = lambda: scd2.unknown_rows(stg, seen, scd2.customer_spec())
    kind = {"seen": "LeftSemi", "staged": "LeftAnti"}[hot_side]
    assert re.search(rf"SortMergeJoin\(skew=true\).*{kind}", forced_skew(spark, search, "1KB"))
    want = stg.join(seen.distinct(), F.col("task_id") == F.col("_have"), "left_anti").count()
    assert search().count() == want
