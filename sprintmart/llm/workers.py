"""What the queries on texts ask of a session: workers that import this package, and Arrow batches that fit texts."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Add this package's folder to the workers' search path, for a session that was started elsewhere
    on one machine. On a cluster the package is installed with the executors, and this changes nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


#: Rows and bytes of an Arrow batch; the defaults are meant for rows of numbers, and texts are long.
BATCH_ROWS = 1_000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Make workers import this package, and let batches be small where the session has no setting of its own."""
    let_workers_import(spark)
    for name, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not spark.conf.isModifiable(key) or spark.sparkContext.getConf().contains(key):
            continue
        spark.conf.set(key, str(value))
