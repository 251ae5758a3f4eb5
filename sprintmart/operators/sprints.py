"""Sprint calendars and the assignment of rows to sprints."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintmart.functions.keys import stable_id
from sprintmart.functions.text import any_column_match

_EPOCH = date(1970, 1, 1)

# The first sprint day, sprint length and sprint count of the 2025 calendar.
FIRST_DAY_2025 = date(2025, 1, 7)
SPRINT_DAYS = 14
SPRINTS_2025 = 25


_NO_WINDOWS = (
    "select 0 as number, date '1970-01-01' as start_date, date '1970-01-01' as end_date,"
    " 1970 as year where false"
)


@dataclass(frozen=True)
class Window:
    """One sprint; both days belong to it."""

    number: int
    start: date
    end: date
    year: int

    @property
    def list_name(self) -> str:
        """The spelling used for task lists: ``Sprint 7 - 2025``."""
        return f"Sprint {self.number} - {self.year}"

    @property
    def label(self) -> str:
        """The spelling used for staged tasks: ``Sprint 7``."""
        return f"Sprint {self.number}"

    @property
    def dim_name(self) -> str:
        """The spelling used in the sprint dimension: ``2025 - Sprint 7``."""
        return f"{self.year} - Sprint {self.number}"


@dataclass(frozen=True)
class Calendar:
    """A run parameter: the sprints in order, windows of any length, gaps allowed."""

    windows: Sequence[Window]

    @staticmethod
    def regular(
        first_day: date, sprints: int, days: int = SPRINT_DAYS, year: int | None = None
    ) -> Calendar:
        """Sprints of equal length without gaps, all named after one year."""
        named = first_day.year if year is None else year
        starts = [first_day + timedelta(days=days * i) for i in range(sprints)]
        return Calendar(
            [Window(i + 1, s, s + timedelta(days=days - 1), named) for i, s in enumerate(starts)]
        )

    def current(self, day: date) -> Window | None:
        return next((w for w in self.windows if w.start <= day <= w.end), None)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per window: a local table, whose size the planner knows."""
        rows = ", ".join(
            f"({w.number}, date '{w.start}', date '{w.end}', {w.year})" for w in self.windows
        )
        text = f"select * from values {rows} as w(number, start_date, end_date, year)"
        frame = spark.sql(text if rows else _NO_WINDOWS)
        label = sprint_label(F.col("number"))
        return frame.select(
            "number",
            "start_date",
            "end_date",
            F.concat(label, F.lit(" - "), F.col("year").cast("string")).alias("list_name"),
            label.alias("label"),
            dim_sprint_key(F.col("year"), label).alias("dim_name"),
        )

    def dimension(self, spark: SparkSession) -> DataFrame:
        """The sprint dimension."""
        return self.frame(spark).select(
            stable_id("dim_sprint", F.col("dim_name")).alias("uuid"), F.col("dim_name").alias("sprint")
        )

    def segments(self) -> list[tuple[date, Window | None]]:
        """First days of the stretches in which one window, or none, holds; of several windows that hold a day the one
        with the smallest number counts, then the first. Sorted, at most twice as many as the windows and one."""
        order = {id(w): (w.number, i) for i, w in enumerate(self.windows)}
        opening = sorted((w for w in self.windows if w.start <= w.end), key=lambda w: w.start)
        cuts = sorted({w.start for w in opening} | {w.end + timedelta(days=1) for w in opening})
        out: list[tuple[date, Window | None]] = []
        held: list[tuple[tuple[int, int], Window]] = []
        at = 0
        for day in cuts:
            while at < len(opening) and opening[at].start <= day:
                heapq.heappush(held, (order[id(opening[at])], opening[at]))
                at += 1
            while held and held[0][1].end < day:
                heapq.heappop(held)
            window = held[0][1] if held else None
            if not out or out[-1][1] is not window:
                out.append((day, window))
        return out


CALENDAR_2025 = Calendar.regular(FIRST_DAY_2025, SPRINTS_2025)


def last_not_after(value: Column, bounds: Sequence[int]) -> Column:
    """How many of the sorted bounds are not after the value, by binary search; 0 for NULL."""
    array = F.lit(list(bounds)) if bounds else F.array().cast("array<int>")

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high + 1) / 2).cast("int")
        reached = F.coalesce(F.get(array, middle - 1) <= value, F.lit(False))
        return F.struct(
            F.when(reached, middle).otherwise(low).alias("low"),
            F.when(reached, high).otherwise(F.greatest(low, middle - 1)).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds).bit_length())))
    return F.aggregate(steps, start, halve, lambda state: state["low"])


#: Columns of a sprint, as a window has them.
_COLUMNS = {"sprint_number": "number", "list_name": "list_name", "label": "label", "dim_name": "dim_name"}


def assign_sprint(df: DataFrame, instant: str, calendar: Calendar, columns: Sequence[str] = ("label",)) -> DataFrame:
    """Add columns of the sprint an instant falls in, NULL outside every window.

    The last day counts to its end; of overlapping windows the one with the smallest number holds. The bounds of the
    calendar are part of the plan and every row is looked up by binary search, whatever the length of the windows:
    nothing is expanded, joined or shuffled.
    """
    segments = calendar.segments()
    bounds = [(first - _EPOCH).days for first, _ in segments]
    found = last_not_after(F.unix_date(F.to_date(F.col(instant))), bounds)
    rows = df.withColumn("_segment", found - 1)
    for column in columns:
        kind = "int" if column == "sprint_number" else "string"
        values = [None if w is None else getattr(w, _COLUMNS[column]) for _, w in segments]
        array = F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>")
        rows = rows.withColumn(column, F.when(F.col("_segment") >= 0, F.get(array, F.col("_segment"))))
    return rows.drop("_segment")


def sprint_index(instant: Column, first_day: date, days: int = SPRINT_DAYS) -> Column:
    """Number of the sprint in an endless regular calendar that starts with 1 on ``first_day``."""
    elapsed = F.date_diff(F.to_date(instant), F.lit(first_day))
    return (F.floor(elapsed / F.lit(days)) + F.lit(1)).cast("bigint")


def sprint_number(label: Column) -> Column:
    """The number in ``Sprint <n>`` anywhere in the text; NULL without one."""
    return F.nullif(F.regexp_extract(label, r"Sprint (\d+)", 1), F.lit("")).try_cast("bigint")


def second_word_number(label: Column) -> Column:
    """The number that is the second space-separated word of a label."""
    return F.nullif(F.split_part(label, F.lit(" "), F.lit(2)), F.lit("")).try_cast("bigint")


def sprint_label(number: Column) -> Column:
    return F.concat(F.lit("Sprint "), number.cast("bigint").cast("string"))


def sprint_option(number: Column) -> Column:
    """The option spelling: at least two digits."""
    text = number.cast("bigint").cast("string")
    padded = F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
    return F.concat(F.lit("Sprint "), padded)


def dim_sprint_key(year: int | Column, label: Column) -> Column:
    """``<year> - <label>``, the key of the sprint dimension; NULL for a NULL label."""
    shown = year if isinstance(year, Column) else F.lit(str(year))
    return F.concat(shown.cast("string"), F.lit(" - "), label)


def current_sprint_rows(tasks: DataFrame, calendar: Calendar, today: date) -> DataFrame:
    """The rows any column of which mentions the current sprint's list, with its number.

    Outside every window the result is empty and keeps its shape.
    """
    window = calendar.current(today)
    if window is None:
        return tasks.filter(F.lit(False)).withColumn("sprint_number", F.lit(None).cast("bigint"))
    found = tasks.filter(any_column_match(tasks, window.list_name))
    return found.withColumn("sprint_number", sprint_number(F.lit(window.list_name)))
