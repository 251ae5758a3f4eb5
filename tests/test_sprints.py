from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from conftest import plan_of
from pyspark.sql import functions as F

from sprintmart.operators.sprints import (
    CALENDAR_2025,
    Calendar,
    Window,
    assign_sprint,
    current_sprint_rows,
    dim_sprint_key,
    second_word_number,
    sprint_index,
    sprint_label,
    sprint_number,
    sprint_option,
)


def test_calendar_of_2025():
    windows = CALENDAR_2025.windows
    assert len(windows) == 25
    assert (windows[0].start, windows[0].end) == (date(2025, 1, 7), date(2025, 1, 20))
    assert (windows[24].start, windows[24].end) == (date(2025, 12, 9), date(2025, 12, 22))
    assert windows[6].list_name == "Sprint 7 - 2025"
    assert windows[6].label == "Sprint 7"
    assert windows[6].dim_name == "2025 - Sprint 7"


def test_current_window_and_gaps():
    assert CALENDAR_2025.current(date(2025, 1, 20)).number == 1
    assert CALENDAR_2025.current(date(2025, 1, 21)).number == 2
    assert CALENDAR_2025.current(date(2025, 1, 6)) is None
    assert CALENDAR_2025.current(date(2025, 12, 23)) is None


def test_long_overlapping_windows_are_looked_up_by_their_bounds(spark):
    rng = random.Random(6)
    windows = []
    for n in range(60):
        start = date(1900, 1, 1) + timedelta(days=rng.randrange(40_000))
        windows.append(Window(n % 50, start, start + timedelta(days=rng.choice([0, 1, 13, 400, 20_000, -1])), n))
    calendar = Calendar(windows)
    days = [date(1899, 12, 31) + timedelta(days=rng.randrange(62_000)) for _ in range(800)]
    days += [w.start for w in windows] + [w.end for w in windows] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = assign_sprint(df, "d", calendar, ("sprint_number", "dim_name"))
    for r in got.collect():
        held = [w for w in windows if r.d is not None and w.start <= r.d <= w.end]
        want = min(held, key=lambda w: w.number, default=None)
        assert (r.sprint_number, r.dim_name) == ((want.number, want.dim_name) if want else (None, None))
    plan = plan_of(got)
    assert not any(kind in plan for kind in ("Join", "Exchange", "Python"))
    assert assign_sprint(df, "d", Calendar([])).filter("label is not null").count() == 0


def test_assignment_at_window_edges(spark):
    calendar = Calendar(
        [
            Window(1, date(2025, 1, 7), date(2025, 1, 20), 2025),
            Window(2, date(2025, 1, 23), date(2025, 1, 24), 2025),
            Window(3, date(2025, 1, 24), date(2025, 1, 30), 2025),
        ]
    )
    cases = {
        datetime(2025, 1, 6, 23, 59, 59): None,
        datetime(2025, 1, 7): "Sprint 1",
        datetime(2025, 1, 20, 23, 59, 59, 999999): "Sprint 1",
        datetime(2025, 1, 21): None,
        datetime(2025, 1, 24, 12): "Sprint 2",
        datetime(2025, 1, 25): "Sprint 3",
        datetime(2025, 1, 31): None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t timestamp_ntz")
    got = assign_sprint(df, "t", calendar)
    assert {r.t: r.label for r in got.collect()} == cases
    plan = plan_of(got)
    assert "Join" not in plan and "Exchange" not in plan


def test_empty_calendar(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 7),)], "t timestamp_ntz")
    assert assign_sprint(df, "t", Calendar([])).first().label is None


def test_arithmetic_equals_the_calendar(spark):
    df = spark.range(400).select(F.date_add(F.lit(date(2025, 1, 1)), F.col("id").cast("int")).alias("t"))
    both = assign_sprint(df, "t", CALENDAR_2025, ("sprint_number",)).withColumn(
        "n", sprint_index(F.col("t"), date(2025, 1, 7))
    )
    for r in both.collect():
        assert r.sprint_number == (r.n if 1 <= r.n <= 25 else None)


def test_labels(spark):
    df = spark.createDataFrame([("Sprint 7 - 2025",), ("x Sprint 12",), ("none",), (None,)], "l string")
    rows = df.select(sprint_number(F.col("l")), second_word_number(F.col("l"))).collect()
    assert [tuple(r) for r in rows] == [(7, 7), (12, None), (None, None), (None, None)]
    numbers = spark.createDataFrame([(7,), (12,), (123,), (None,)], "n int")
    shown = numbers.select(
        sprint_label(F.col("n")), sprint_option(F.col("n")), dim_sprint_key(2025, sprint_label(F.col("n")))
    ).collect()
    assert [tuple(r) for r in shown] == [
        ("Sprint 7", "Sprint 07", "2025 - Sprint 7"),
        ("Sprint 12", "Sprint 12", "2025 - Sprint 12"),
        ("Sprint 123", "Sprint 123", "2025 - Sprint 123"),
        (None, None, None),
    ]


def test_current_sprint_rows(spark):
    df = spark.createDataFrame(
        [("1", ("Sprint 7 - 2025",), "a"), ("2", ("Sprint 17 - 2025",), "a"), ("3", (None,), "see Sprint 7 - 2025")],
        "id string, list struct<name string>, description string",
    )
    got = current_sprint_rows(df, CALENDAR_2025, date(2025, 4, 1))
    assert sorted((r.id, r.sprint_number) for r in got.collect()) == [("1", 7), ("3", 7)]
    nothing = current_sprint_rows(df, CALENDAR_2025, date(2026, 4, 1))
    assert nothing.count() == 0 and nothing.schema.simpleString() == got.schema.simpleString()
