"""Dates and instants. Days are ``DateType``; text forms appear only at the edges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart.functions.text import null_tokens_to_null

DAY_FIRST = "dd/MM/yyyy"
# Milliseconds of 9999-12-31T23:59:59.999Z: later instants have no calendar date here.
_MAX_EPOCH_MS = 253402300799999
_DAY_MS = 86_400_000


def parse_day_first(column: Column, strict: bool = False) -> Column:
    """``dd/MM/yyyy`` text as a date. Strict raises on malformed text, otherwise it gives NULL."""
    text = null_tokens_to_null(column)
    return F.to_date(text, DAY_FIRST) if strict else F.try_to_date(text, DAY_FIRST)


def format_day_first(column: Column) -> Column:
    return F.date_format(column, DAY_FIRST)


def iso_date(column: Column) -> Column:
    """The UTC day of an ISO-8601 text; NULL when malformed.

    Text without a zone is UTC because the session runs in UTC.
    """
    return F.to_date(F.try_to_timestamp(column))


def epoch_ms_date(column: Column, tz: str = "UTC") -> Column:
    """The calendar day in zone ``tz`` of epoch milliseconds, as digits or as a number of any type.

    Anything else gives NULL. Days are counted from shifted milliseconds, so the session time zone
    plays no part.
    """
    # As text, a large double has an exponent.
    floating = F.typeof(column).isin("double", "float")
    text = F.when(floating, column.try_cast("bigint").cast("string")).otherwise(column.cast("string"))
    ms = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    ms = F.when(ms <= _MAX_EPOCH_MS, ms)
    local = ms if tz == "UTC" else F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(ms), tz))
    return F.date_from_unix_date(F.floor(local / F.lit(_DAY_MS)).cast("int"))


def latest(*columns: Column) -> Column:
    """The latest of several dates, skipping NULLs."""
    return F.greatest(*columns)


def import_stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Add the run's day and instant, one literal for every row and branch of a run."""
    return df.withColumns(
        {
            "import_date": F.lit(run_ts.date()),
            "import_date_time": F.lit(run_ts),
        }
    )


def expires_at(run_ts: Column, days: int = 1) -> Column:
    """The instant after which a run's intermediate tables may be dropped."""
    return run_ts + F.expr(f"interval {int(days)} day")
