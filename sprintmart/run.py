"""Spark job for one night.

    spark-submit sprintmart/run.py --landing <folder> --mart <folder> --settings settings.json

The settings file holds what differs between installations::

    {
      "calendar": {"first_day": "2025-01-07", "sprints": 25, "days": 14},
      "skipped_spaces": ["..."], "sprint_space": "...", "sprint_folder": "...",
      "team_field": {"id": "...", "name": "...", "options": {"Red": 0, "Blue": 1}},
      "excluded_service": "...", "tz": "America/Sao_Paulo", "duplicates": "error"
    }

Further settings, with their defaults: ``change`` ("import_date"; or "attributes"), ``team_key`` (true: one chain
of versions per key and team), ``matching_key`` (false), ``consolidate`` (false), ``services`` (false: also store
the purchased services), ``year``. With ``--list-obsolete`` the run ends by printing folders that a cleaner may
drop: intermediate tables of a day ago, and active rows that a later run replaced.

An irregular calendar lists its windows instead: ``{"windows": [[1, "2025-01-07", "2025-01-20", 2025]]}``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping
from datetime import date, datetime, timezone
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession

from sprintmart.operators.history import TeamField
from sprintmart.operators.sprints import SPRINT_DAYS, Calendar, Window
from sprintmart.plans.nightly import DIMENSIONS, STAGES, Settings, publish_night, read_landing
from sprintmart.plans.tables import RUN_FORMAT, Tables
from sprintmart.session import build_session
from sprintmart.sources.workspace import TreeRules

OPTIONAL = (
    "excluded_service", "tz", "sprint_field", "duplicates", "change", "team_key", "matching_key", "consolidate",
    "services", "year",
)


def calendar_of(spec: Mapping[str, Any]) -> Calendar:
    if "windows" in spec:
        day = date.fromisoformat
        return Calendar([Window(n, day(a), day(b), y) for n, a, b, y in spec["windows"]])
    first = date.fromisoformat(spec["first_day"])
    return Calendar.regular(first, spec["sprints"], spec.get("days", SPRINT_DAYS), spec.get("year"))


def settings_of(spec: Mapping[str, Any], run_ts: datetime) -> Settings:
    """The run's settings; the sprint list read is that of the current sprint.

    The current day is that of the configured zone, the one task days are counted in.
    """
    return Settings(
        run_ts=run_ts,
        today=run_ts.astimezone(ZoneInfo(spec.get("tz", "UTC"))).date(),
        calendar=calendar_of(spec["calendar"]),
        rules=TreeRules(
            tuple(spec.get("skipped_spaces", ())), spec.get("sprint_space"), spec.get("sprint_folder")
        ),
        team_field=TeamField(**spec["team_field"]),
        **{k: spec[k] for k in OPTIONAL if k in spec},
    )


def run(spark: SparkSession, landing: str, mart: str, spec: Mapping[str, Any], run_ts: datetime) -> Tables:
    tables = Tables(spark, mart, run_ts.strftime(RUN_FORMAT))
    publish_night(read_landing(spark, landing), tables, settings_of(spec, run_ts))
    return tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one night of the data mart.")
    for name in ("landing", "mart", "settings"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--run-ts", help="ISO instant of the run, by default now; repeat it to redo a run")
    parser.add_argument("--list-obsolete", action="store_true", help="print folders that may be dropped")
    parser.add_argument("--keep-days", type=int, help="drop intermediate and superseded files older than this")
    args = parser.parse_args(argv)
    run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else datetime.now(timezone.utc)
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    with open(args.settings, encoding="utf-8") as file:
        spec = json.load(file)
    spark = build_session("sprintmart-nightly")
    try:
        run_ts = run_ts.astimezone(timezone.utc).replace(microsecond=0)
        tables = run(spark, args.landing, args.mart, spec, run_ts)
        if args.keep_days is not None:
            tables.drop_expired(run_ts, args.keep_days, DIMENSIONS, STAGES)
        if args.list_obsolete:
            for path in [*tables.expired_stages(run_ts), *(p for t in DIMENSIONS for p in tables.superseded(t))]:
                print(path)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
