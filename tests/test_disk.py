"""What a landing and a night leave on disk, over rows made here."""

from __future__ import annotations

import time
from datetime import datetime, timedelta
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from sprintmart.queries import fixtures as fx
from sprintmart.queries import marts
from sprintmart.queries.registry import Data
from sprintmart.session import _CLEANUP, brief_shuffles, release_driver

ORDERS = 1500


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Orders of some lists, among them rows with nulls and repeated rows, and their customers and suppliers."""
    root = tmp_path_factory.mktemp("tables")
    first = datetime(1995, 1, 1) + timedelta(days=14 * 60)
    orders = [
        (i, i % 150, "FOP"[i % 3], 1.5 * i, first + timedelta(days=i % 140), f"{i % 5 + 1}-URGENT") for i in range(ORDERS)
    ]
    orders += [orders[7], (None, 3, None, None, first, None)]
    made = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(i, f"Customer#{i}", i % 25, 1.0, "BUILDING") for i in range(150)], "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"),
        "supplier": ([(i, f"Supplier#{i:09}", i % 25) for i in range(12)], "s_suppkey bigint, s_name string, s_nationkey bigint"),
        "nation": ([(i, f"NATION_{i}", i % 5) for i in range(25)], "n_nationkey bigint, n_name string, n_regionkey bigint"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return Data(spark, str(root))


def landed_files(landed, kind: str) -> list[Path]:
    return [Path(unquote(p.removeprefix("file://"))) for p in getattr(landed, kind).inputFiles()]


def test_landed_tasks_are_whole_and_take_a_fraction_of_their_text(spark, small):
    landed = marts.landing(small)
    tasks = landed.task_pages.select(F.explode("tasks").alias("t")).select("t.*")
    wanted = fx.task_records(small)
    as_text = lambda df: df.select(F.to_json(F.struct(*[F.col(c) for c in wanted.columns])).alias("t"))
    got, text = as_text(tasks), as_text(wanted)
    assert got.exceptAll(text).count() == text.exceptAll(got).count() == 0
    size = sum(f.stat().st_size for f in landed_files(landed, "task_pages"))
    assert size * 5 < text.agg(F.sum(F.length("t"))).first()[0]


def test_nested_tasks_are_not_moved(spark, small):
    """Flat tasks are dealt to their lists; the fields that make them large come after."""
    flat = small.sql(fx.TASKS).withColumn("list_id", fx.list_name(F.col("day")))
    pages = flat.select("list_id", F.array(F.struct(*[c for c in flat.columns if c != "list_id"])).alias("tasks"))
    nested = marts.nested_tasks(pages.hint("rebalance", "list_id").sortWithinPartitions("list_id"))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = nested._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "Exchange" in plan and plan.index("Agile Category") < plan.index("Exchange")
    assert "Agile Category" not in plan[plan.index("Exchange"):]


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {blocks.apply(i).getName() for i in range(blocks.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_a_night_leaves_no_shuffle_files(spark, small):
    before = shuffle_files(spark)
    _, night = marts.publish(small)
    left = set()
    for _ in range(100):
        # Files are deleted by a thread of their own.
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert night.fact_rows.count() > 0 and night.customer.new.count() > 0
    assert spark.conf.get(_CLEANUP, "false") == "false"


def test_a_setting_of_the_session_stays(spark):
    with brief_shuffles(spark):
        with brief_shuffles(spark):
            pass
        assert spark.conf.get(_CLEANUP) == "true"
    spark.conf.set(_CLEANUP, "true")
    try:
        with brief_shuffles(spark):
            pass
        assert spark.conf.get(_CLEANUP) == "true"
    finally:
        spark.conf.unset(_CLEANUP)
    assert spark.conf.get(_CLEANUP, "false") == "false"


def full_collections(spark) -> int:
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_the_driver_gives_back_frames_that_nothing_refers_to(spark):
    frame = spark.range(10)
    frame.itself = frame  # a cycle, as tracebacks and closures leave them
    plan = spark._jvm.java.lang.ref.WeakReference(frame._jdf)
    release_driver(spark)
    assert plan.get() is not None
    del frame
    for _ in range(20):
        release_driver(spark)
        if plan.get() is None:
            break
        time.sleep(0.1)  # py4j lets go of an object in a thread of its own
    assert plan.get() is None


def test_a_night_gives_the_drivers_memory_back_after_each_step(spark, small):
    before = full_collections(spark)
    tables, night = marts.publish(small)
    assert night.fact_rows.count() >= 0
    # Nine pages landed together, some twenty stored tables and three merges.
    assert full_collections(spark) - before >= 20
