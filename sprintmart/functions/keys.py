"""Deterministic row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(table: str, *parts: Column) -> Column:
    """An id that depends only on its parts.

    A recomputed task gets the same id again, which a random one would not.
    """
    texts = [F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws("~", F.lit(table), *texts))
