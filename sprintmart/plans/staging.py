"""The staging tables: renaming by name, typing, cleaning, the import stamp."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintmart.functions.dates import epoch_ms_date, format_day_first, import_stamp, iso_date, latest
from sprintmart.functions.fields import first_item, option_of_field, scalar_of_field, user_of_field
from sprintmart.functions.numbers import (
    round_half_even,
    safe_int,
    to_bool,
    to_identifier,
    to_number,
    to_whole,
    whole_or_zero,
)
from sprintmart.functions.text import lacks_text, null_tokens_to_null, trim_ws, value_map
from sprintmart.operators.consolidate import CUSTOMER_CONSOLIDATION, Consolidation
from sprintmart.operators.joins import left_lookup
from sprintmart.operators.sprints import sprint_label
from sprintmart.schemas import STG_CUSTOMER, STG_SERVICE, STG_SQUAD, STG_TASK

# Membership status as staged.
MEMBER_STATUS = {"Active": "ON THE TEAM", "Inactive": "LEFT THE TEAM"}
# The category whose tasks belong to a team of their own.
CUSTOMER_CATEGORY, CUSTOMER_TEAM = "Customer task", "Customer"
# Fixed value: customer of a task that names none.
UNKNOWN_CUSTOMER = "Unknown Customer"


def project(df: DataFrame, mapping: Iterable[tuple[str, str | Column]]) -> DataFrame:
    """Select by (new name, source); a source may feed several outputs."""
    return df.select(
        *[(F.col(f"`{src}`") if isinstance(src, str) else src).alias(new) for new, src in mapping]
    )


def constant(value: object, dtype: str) -> Column:
    return F.lit(value).cast(dtype)


def overwrite_when(df: DataFrame, test: Column, column: str, value: Column) -> DataFrame:
    """Set a column where ``test`` holds; a NULL test leaves it."""
    return df.withColumn(column, F.when(test, value).otherwise(F.col(column)))


def fill_missing(df: DataFrame) -> DataFrame:
    """0 for every missing scalar, in the spelling of the column's type."""
    return df.na.fill(0).na.fill("0").na.fill(False)


def clean_text(df: DataFrame) -> DataFrame:
    """Trim every string column and turn spelled-out missing values into NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_tokens_to_null(trim_ws(F.col(c))) for c in strings})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema in their types, and the rejected values if they were noted."""
    noted = [REJECTS] if REJECTS in df.columns else []
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *noted)


# --- values that staging makes NULL because they spell nothing of the column's type -------------

REJECTS = "_rejects"

#: Checked columns of each stage.
CHECKED = {
    "stg_squad": ("capacity_points", "start_date", "due_date", "date_created", "date_updated"),
    "stg_customer": (
        "plan_points", "monthly_revenue", "start_date", "service_end_date", "service_due_date", "crm_id",
        "date_created", "date_updated",
    ),
    "stg_task": (
        "start_date", "due_date", "date_closed", "date_done", "date_created", "date_updated", "quality_score",
    ),
}


def rejected(stage: str, values: Mapping[str, tuple[Column, Column]], wanted: bool) -> list[tuple[str, Column]]:
    """The noted column of a stage: (field, raw text) of every value that has text but none of the column's type.
    ``values`` holds (raw, parsed) by column, in the order of ``CHECKED``."""
    if not wanted:
        return []
    if tuple(values) != CHECKED[stage]:
        raise ValueError(f"{stage} checks {CHECKED[stage]}, not {tuple(values)}")

    def test(column: str, raw: Column, parsed: Column) -> Column:
        text = raw.cast("string")
        has_text = F.coalesce(null_tokens_to_null(trim_ws(text)), F.lit("")) != ""
        return F.when(has_text & parsed.isNull(), F.struct(F.lit(column).alias("field"), text.alias("raw")))

    return [(REJECTS, F.array_compact(F.array(*[test(c, *v) for c, v in values.items()])))]


def counted(stage: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A stage with its rejected values counted while it is written: rows and rejects by column."""
    seen = Observation(f"rejects of {name}")

    def times(column: str) -> Column:
        return F.sum(F.size(F.filter(REJECTS, lambda r: r["field"] == column))).alias(column)

    by_column = [times(c) for c in CHECKED[name]]
    return stage.observe(seen, F.count(F.lit(1)).alias("rows"), *by_column), seen


def reject_rows(stage: DataFrame, name: str, key: str = "task_id") -> DataFrame:
    """(stage, key, field, raw) of a stored stage's rejected values, of which two columns are read."""
    found = stage.select(F.col(key).alias("key"), F.explode(REJECTS).alias("r"))
    return found.select(F.lit(name).alias("stage"), "key", "r.field", "r.raw")


def stg_squad(members: DataFrame, run_ts: datetime, rejects: bool = False) -> DataFrame:
    """Staged members: 14 columns and the import stamp."""
    checks = {
        "capacity_points": (F.col("capacity_points"), to_number(F.col("capacity_points"))),
        **{
            name: (F.col(raw), iso_date(F.col(raw)))
            for name, raw in (
                ("start_date", "start_date"), ("due_date", "departure_date"), ("date_created", "hs_createdate"),
                ("date_updated", "hs_lastmodifieddate"),
            )
        },
    }
    day = lambda c: format_day_first(iso_date(F.col(c)))
    staged = project(
        members,
        [
            ("task_id", "id"),
            ("task_name", "member_name"),
            ("position", "function"),
            ("email", "member_email"),
            ("capacity_points", to_number(F.col("capacity_points"))),
            ("monthly_cost", constant(0, "double")),
            ("team", "squad_name"),
            ("slack_channel", constant(None, "string")),
            ("status", value_map(F.col("member_status"), MEMBER_STATUS)),
            ("list", constant(None, "string")),
            ("start_date", day("start_date")),
            ("due_date", day("departure_date")),
            ("date_created", iso_date(F.col("hs_createdate"))),
            ("date_updated", iso_date(F.col("hs_lastmodifieddate"))),
            *rejected("stg_squad", checks, rejects),
        ],
    )
    return conform(import_stamp(clean_text(staged), run_ts), STG_SQUAD)


def _customer_columns(customers: DataFrame, rejects: bool) -> DataFrame:
    nothing = constant(None, "string")
    number = lambda c: (F.col(c), to_number(F.col(c)))
    day = lambda c: (F.col(c), iso_date(F.col(c)))
    checks = {
        "plan_points": number("sprint_points_plan"),
        "monthly_revenue": number("mrr"),
        "start_date": day("service_start_date"),
        "service_end_date": day("service_end_date"),
        "service_due_date": day("service_due_date"),
        "crm_id": (F.col("subscription_crm_id"), to_identifier(F.col("subscription_crm_id"))),
        "date_created": day("createdAt"),
        "date_updated": day("updatedAt"),
    }
    return project(
        customers,
        [
            ("task_id", "id"),
            ("task_name", "customer_name"),
            ("customer", "customer_name"),
            ("plan", nothing),
            ("plan_points", to_number(F.col("sprint_points_plan"))),
            ("currency", F.upper("service_currency")),
            ("monthly_revenue", to_number(F.col("mrr"))),
            ("term", constant(None, "bigint")),
            ("start_date", iso_date(F.col("service_start_date"))),
            ("go_live_date", constant(None, "date")),
            ("last_renew_date", constant(None, "date")),
            ("due_date", latest(iso_date(F.col("service_end_date")), iso_date(F.col("service_due_date")))),
            ("has_growth_formula", to_bool(F.col("growth_formula_implemented"))),
            ("slack_channel", "slack_channel"),
            ("team", "squad_name"),
            ("crm_id", "subscription_crm_id"),
            ("list", nothing),
            ("temperature", nothing),
            ("date_created", iso_date(F.col("createdAt"))),
            ("date_updated", iso_date(F.col("updatedAt"))),
            ("chances_to_renew", nothing),
            ("renewal_term", constant(None, "bigint")),
            ("status", "service_status"),
            ("service_name", "service_name"),
            *rejected("stg_customer", checks, rejects),
        ],
    )


def _either(how: Consolidation, columns: list[str], order: Column) -> list[Column]:
    """Per column: the row's own value where the key occurs once, else the consolidated one."""
    combined = how.aggregates(order)
    row = F.any_value(F.struct(*columns))
    once = F.count(F.lit(1)) == 1
    return [
        F.when(once, row[c]).otherwise(combined.get(c, F.lit(None))).alias(c)
        for c in columns
        if c != how.key
    ]


def stg_customer(
    customers: DataFrame,
    run_ts: datetime,
    excluded_service: str | None = None,
    consolidate: bool = False,
    order: Column | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Staged customers: 24 columns and the import stamp.

    By default every row of a repeated ``task_id`` stays. ``consolidate=True`` makes one row of
    them, which leaves the columns the consolidation does not cover empty (service name, plan,
    renewal and list fields); both cases come out of a single aggregation. Rejected values are noted row by
    row, so not for merged ones.
    """
    if rejects and consolidate:
        raise ValueError("rejected values are noted for rows that are not merged")
    staged = _customer_columns(customers, rejects)
    if consolidate:
        by = order if order is not None else F.struct("date_created", "service_name", "team")
        columns = staged.columns
        keyed = staged.filter(F.col("task_id").isNotNull())
        merged = keyed.groupBy("task_id").agg(*_either(CUSTOMER_CONSOLIDATION, columns, by))
        staged = merged.select(*columns).unionByName(staged.filter(F.col("task_id").isNull()))
    typed = clean_text(
        staged.withColumns(
            {
                "plan_points": to_whole(F.coalesce(F.col("plan_points"), F.lit(0.0))),
                "monthly_revenue": round_half_even(F.col("monthly_revenue"), 2),
            }
        )
    ).withColumn("crm_id", to_identifier(F.col("crm_id")))
    if excluded_service:
        typed = typed.filter(lacks_text(F.col("service_name"), excluded_service))
    return conform(import_stamp(typed, run_ts), STG_CUSTOMER)


def stg_service(customers: DataFrame) -> DataFrame:
    """The purchased services, 14 columns, days as text."""
    day = lambda c: format_day_first(iso_date(F.col(c)))
    return conform(
        project(
            customers,
            [
                ("id", "id"),
                ("customer", "customer_name"),
                ("service_name", "service_name"),
                ("plan", "subscription_service_plan"),
                ("plan_points", whole_or_zero(F.col("sprint_points_plan"))),
                ("service_type", "service_type"),
                ("currency", F.upper("service_currency")),
                ("payment_frequency", "payment_frequency"),
                ("mrr", round_half_even(to_number(F.col("mrr")), 2)),
                ("term", constant(None, "bigint")),
                ("status", "service_status"),
                ("service_start_date", day("service_start_date")),
                ("service_end_date", day("service_end_date")),
                ("service_due_date", day("service_due_date")),
            ],
        ),
        STG_SERVICE,
    )


def task_fields(tasks: DataFrame) -> DataFrame:
    """Add the six values held in custom fields and assignees."""
    fields, assignees = F.col("custom_fields"), F.col("assignees")
    return tasks.withColumns(
        {
            "reviewer": user_of_field(fields, "Reviewer"),
            "assignee": first_item(assignees, "username"),
            "email": first_item(assignees, "email"),
            "agile_category": option_of_field(fields, "Agile Category"),
            "customer": option_of_field(fields, "Customer", UNKNOWN_CUSTOMER),
            "quality_score": scalar_of_field(fields, "Quality Score"),
        }
    )


def stg_task(
    tasks: DataFrame,
    squads: DataFrame,
    run_ts: datetime,
    tz: str = "UTC",
    sprint_column: str = "sprint_number",
    rejects: bool = False,
) -> DataFrame:
    """Staged tasks: 21 columns and the import stamp. ``squads`` is the staged member table.

    The quality score is staged as text; noted are those that the dimension will not take for a number."""
    day = lambda c: epoch_ms_date(F.col(c), tz)
    checks = {c: (F.col(c), day(c)) for c in CHECKED["stg_task"][:-1]}
    checks["quality_score"] = (F.col("quality_score"), safe_int(F.col("quality_score")))
    points = to_whole(F.col("points"))
    typed = project(
        task_fields(tasks),
        [
            ("task_id", "id"),
            ("task_name", "name"),
            ("assignee", "assignee"),
            ("reviewer", "reviewer"),
            ("priority", F.upper(F.col("priority.priority"))),
            ("category", "agile_category"),
            ("status", F.upper(F.col("status.status"))),
            ("points_estimate", points),
            ("points_estimate_rolled_up", points),
            *[
                (c, day(c))
                for c in ("start_date", "due_date", "date_closed", "date_done", "date_created", "date_updated")
            ],
            ("customer", "customer"),
            ("list", F.col("list.name")),
            ("sprint", sprint_label(F.col(sprint_column))),
            ("quality_score", "quality_score"),
            ("email", "email"),
            *rejected("stg_task", checks, rejects),
        ],
    )
    teams = squads.select(F.col("email").alias("_email"), "team")
    joined = left_lookup(typed, teams, "email", "_email", spread_by="task_id")
    joined = overwrite_when(joined, F.col("category") == CUSTOMER_CATEGORY, "team", F.lit(CUSTOMER_TEAM))
    return conform(import_stamp(clean_text(joined), run_ts), STG_TASK)
