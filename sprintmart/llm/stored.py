"""Intermediate tables in the shared scratch folder, which survive lost executors and cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sprintmart.session import scratch_dir


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once and read back."""
    path = scratch_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
