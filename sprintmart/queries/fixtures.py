"""Inputs derived from the test tables.

The flat statements run in both engines; Spark then nests them into the landed JSON forms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintmart import schemas
from sprintmart.operators.sprints import sprint_index
from sprintmart.queries.registry import Data

PAGE = 100
SPRINT_OPTIONS = 12
RUN_TS = datetime(2025, 1, 15, 22, 32, tzinfo=timezone.utc)
FIRST_DAY = date(1995, 1, 1)

MEMBERS = """
select cast(s_suppkey as string) as id,
       cast(date '2023-01-01' + cast(s_suppkey % 365 as int) as string) || 'T03:04:05Z' as createdAt,
       cast(date '2024-01-01' + cast(s_suppkey % 365 as int) as string) || 'T03:04:05Z' as updatedAt,
       s_suppkey % 9 = 8 as archived,
       '  ' || s_name || chr(9) as member_name,
       'user' || cast(s_suppkey as string) || '@example.com' as member_email,
       case when s_suppkey % 3 = 0 then 'Active' when s_suppkey % 3 = 1 then 'Inactive'
            else 'ON-LEAVE now' end as member_status,
       case when s_nationkey % 2 = 0 then 'Analyst' else 'Developer' || chr(160) end as function,
       case when s_suppkey % 7 = 3 then 'n/a' else cast(s_suppkey % 40 as string) || '.5' end
         as capacity_points,
       case when s_suppkey % 11 = 5 then 'soon'
            else cast(date '2024-01-01' + cast(s_suppkey % 300 as int) as string) end as start_date,
       case when s_suppkey % 5 = 0
            then cast(date '2024-12-01' + cast(s_suppkey % 60 as int) as string) end as departure_date,
       'boss' as manager,
       'remote' as modality,
       cast(s_suppkey as string) as hs_object_id,
       cast(date '2023-01-01' + cast(s_suppkey % 365 as int) as string) || 'T23:30:00.123Z'
         as hs_createdate,
       cast(date '2024-01-01' + cast(s_suppkey % 365 as int) as string) || 'T00:00:00Z'
         as hs_lastmodifieddate
from {supplier}
"""

# Every member is in the team of the supplier's nation, every tenth in a second one, every
# seventh in none, and every ninth is linked to a team that was never delivered.
MEMBER_TEAMS = """
select s_suppkey as record, cast(s_nationkey as bigint) as linked from {supplier}
where s_suppkey % 7 <> 0
union all
select s_suppkey, cast((s_nationkey + 1) % 25 as bigint) from {supplier} where s_suppkey % 10 = 3
union all
select s_suppkey, cast(999 as bigint) from {supplier} where s_suppkey % 9 = 4
"""

TEAMS = """
select cast(n_nationkey as string) as id, cast(null as string) as createdAt,
       cast(null as string) as updatedAt, false as archived, n_name as squad_name
from {nation}
"""

CUSTOMERS = """
select cast(c_custkey as string) as id,
       cast(date '2023-01-01' + cast(c_custkey % 400 as int) as string) || 'T03:04:05Z' as createdAt,
       cast(date '2024-01-01' + cast(c_custkey % 400 as int) as string) || 'T21:00:00.5Z' as updatedAt,
       false as archived,
       c_name as customer_name,
       c_mktsegment as customer_status,
       case when c_custkey % 4 = 0 then 'true' when c_custkey % 4 = 1 then 'false'
            when c_custkey % 4 = 2 then '' end as growth_formula_implemented,
       case when c_custkey % 9 = 4 then 'none' else cast(c_custkey * 10 as string) end
         as subscription_crm_id,
       cast(null as string) as hs_createdate,
       cast(null as string) as hs_lastmodifieddate
from {customer}
"""

# A customer's purchases are its orders.
CUSTOMER_PURCHASES = "select o_custkey as record, o_orderkey as linked from {orders}"

PURCHASES = """
select cast(o_orderkey as string) as id,
       cast(null as string) as createdAt, cast(null as string) as updatedAt, false as archived,
       cast(o_orderkey as string) as hs_object_id,
       cast(o_totalprice as string) as amount,
       '0' as discount,
       cast(o_totalprice as string) as gross_value,
       case when o_orderkey % 13 = 6 then 'n/a' else cast(o_totalprice as string) end as mrr,
       '0' as intermediation_fee,
       case when o_orderkey % 5 = 0 then 'Yearly' else 'Monthly' end as payment_frequency,
       cast(null as string) as payment_start_date,
       cast(null as string) as payment_end_date,
       case when o_orderkey % 50 = 7 then 'ACME Labs ' when o_orderkey % 50 = 8 then 'acmeLABS '
            else 'Service ' end || cast(o_orderkey as string) as service_name,
       case when o_orderkey % 3 = 0 then 'Recurring' else 'One-off' end as service_type,
       case when o_orderstatus = 'O' then 'active' when o_orderstatus = 'P' then 'on-hold'
            else 'cancelled by client' end as service_status,
       case when o_orderkey % 2 = 0 then 'brl' else 'Usd' end as service_currency,
       cast(cast(o_orderdate as date) as string) as service_start_date,
       case when o_orderkey % 4 <> 1 then cast(cast(o_orderdate as date)
            + cast(90 as int) as string) || 'T12:00:00Z' end as service_end_date,
       case when o_orderkey % 4 = 2 then 'later' when o_orderkey % 4 <> 3
            then cast(cast(o_orderdate as date) + cast(o_orderkey % 200 as int) as string) end
         as service_due_date,
       case when o_orderkey % 17 = 3 then cast(null as string)
            else cast(o_orderkey % 50 as string) || '.5' end as sprint_points_plan,
       o_orderpriority as subscription_service_plan,
       '#c' || cast(o_custkey as string) as slack_channel
from {orders}
"""

# Most purchases have one team, some two, some none, some one that was never delivered.
PURCHASE_TEAMS = """
select o_orderkey as record, o_orderkey % 25 as linked from {orders} where o_orderkey % 10 <> 4
union all
select o_orderkey, (o_orderkey + 1) % 25 from {orders} where o_orderkey % 10 = 3
union all
select o_orderkey, cast(999 as bigint) from {orders} where o_orderkey % 100 = 99
"""

# A task per order, worked on by a member, bought by the customer's first service.
TASKS = """
select cast(o_orderkey as string) as id,
       chr(9) || 'Task ' || cast(o_orderkey as string) || ' ' as name,
       case when o_orderkey % 6 <> 5 then 'about ' || o_orderpriority end as description,
       case when o_orderstatus = 'F' then 'done' when o_orderstatus = 'O' then 'complete'
            else 'in-progress' end as status,
       case when o_orderkey % 8 <> 7 then lower(substring(o_orderpriority, 3, 20)) end as priority,
       case when o_orderkey % 8 <> 7 then substring(o_orderpriority, 1, 1) end as priority_id,
       case when o_orderkey % 19 <> 4 then cast(o_orderkey % 30 as double) / 2 end as points,
       cast(o_orderdate as date) as day,
       o_orderkey,
       o_custkey
from {orders}
"""

CATEGORIES = ("Customer task", "bug-fix", "Data pipeline", "improvement")


def page_number() -> Column:
    """Numbers rows so that no page exceeds ``PAGE``, whatever values repeat in them."""
    return F.floor(F.monotonically_increasing_id() / F.lit(PAGE))


def _record(properties: Sequence[str]) -> Column:
    return F.struct(
        "id", "createdAt", "updatedAt", "archived", F.struct(*properties).alias("properties")
    )


_LINKED = "linked"


def page_text(flat: DataFrame, properties: Sequence[str]) -> DataFrame:
    """Records nested as landed search pages, one JSON text per page of up to ``PAGE``."""
    after = F.struct(F.struct(F.lit("next-page").alias("after")).alias("next")).alias("paging")
    numbered = flat.select(page_number().alias("number"), _record(properties).alias("record"))
    pages = numbered.groupBy("number").agg(F.collect_list("record").alias("results"))
    return pages.select(F.to_json(F.struct("results", after)).alias("page"))


def association_text(flat: DataFrame) -> DataFrame:
    """(record, linked) pairs nested as association pages, one JSON text per page."""
    record = F.col("record").cast("string").alias("record_id")
    linked = F.struct(F.col(_LINKED).cast("string").alias("id"))
    numbered = flat.select(record, page_number().alias("number"), linked.alias("linked"))
    pages = numbered.groupBy("record_id", "number").agg(F.collect_list("linked").alias("results"))
    return pages.select(F.to_json(F.struct("record_id", "results")).alias("page"))


def _pages(flat: DataFrame, schema: T.StructType) -> DataFrame:
    """Search pages as the reader delivers them, one record each, which takes no shuffle."""
    results = schema["results"].dataType
    properties = results.elementType["properties"].dataType.fieldNames()
    return flat.select(F.array(_record(properties)).cast(results).alias("results"))


def associations(flat: DataFrame) -> DataFrame:
    """Association pages as the reader delivers them, one link each."""
    linked = F.array(F.struct(F.col(_LINKED).cast("string").alias("id")))
    return flat.select(F.col("record").cast("string").alias("record_id"), linked.alias("results"))


def member_pages(d: Data) -> DataFrame:
    return _pages(d.sql(MEMBERS), schemas.MEMBER_PAGE)


def team_pages(d: Data) -> DataFrame:
    return _pages(d.sql(TEAMS), schemas.TEAM_PAGE)


def customer_pages(d: Data) -> DataFrame:
    return _pages(d.sql(CUSTOMERS), schemas.CUSTOMER_PAGE)


def purchase_pages(d: Data) -> DataFrame:
    return _pages(d.sql(PURCHASES), schemas.PURCHASE_PAGE)


def member_team_pages(d: Data) -> DataFrame:
    return associations(d.sql(MEMBER_TEAMS))


def customer_purchase_pages(d: Data) -> DataFrame:
    return associations(d.sql(CUSTOMER_PURCHASES))


def purchase_team_pages(d: Data) -> DataFrame:
    return associations(d.sql(PURCHASE_TEAMS))


def _options(names: Sequence[str]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(f"o{i}").alias("id"), F.lit(n).alias("name"), F.lit(i * 3).alias("orderindex")
            )
            for i, n in enumerate(names)
        ]
    )


def _field(name: str, kind: str, value: Column, options: Column | None = None) -> Column:
    choices = F.lit(None) if options is None else options
    return F.struct(
        F.lit(name.lower().replace(" ", "-")).alias("id"),
        F.lit(name).alias("name"),
        F.lit(kind).alias("type"),
        value.cast("string").alias("value"),
        F.struct(choices.alias("options")).alias("type_config"),
    ).cast(schemas.CUSTOM_FIELD)


def list_name(day: Column) -> Column:
    """The list that a task of a day is in."""
    return F.concat(F.lit("Sprint "), sprint_index(day, FIRST_DAY).cast("string"), F.lit(" - 1995"))


def task_records(d: Data) -> DataFrame:
    """Tasks in their nested form, with custom fields of every kind."""
    return d.sql(TASKS).select(*task_columns())


def task_columns(of: Callable[[str], Column] = F.col) -> list[Column]:
    """A task's nested form from its flat columns, which ``of`` finds by name."""
    key, day, status, priority = of("o_orderkey"), of("day"), of("status"), of("priority")
    member = F.floor(of("o_custkey") / F.lit(14)).cast("bigint")
    name = F.concat(F.lit("Supplier#"), F.lpad(member.cast("string"), 9, "0"))
    user = F.struct(
        member.alias("id"),
        F.concat(F.lit(" "), name).alias("username"),
        F.concat(F.lit("user"), member.cast("string"), F.lit("@example.com")).alias("email"),
    )
    listed = F.to_json(F.array(F.struct(name.alias("username"))))
    # Position 4 lies outside the list, and some values are no number at all.
    category = F.when(key % 10 == 9, F.lit("none")).when(key % 10 != 8, (key % 5).cast("string"))
    quality = F.when(key % 6 == 0, F.lit("8.0")).when(key % 6 < 4, (key % 10).cast("string"))
    service = F.concat(F.lit("Service "), key.cast("string"))
    fields = F.array(
        _field("Reviewer", "users", listed),
        _field("Reviewer", "users", F.when(key % 4 == 0, F.lit("[]"))),
        _field("Agile Category", "drop_down", category, _options(CATEGORIES)),
        _field(
            "Customer",
            "drop_down",
            F.when(key % 7 != 6, F.lit("1")),
            F.array(
                F.struct(F.lit("x").alias("id"), F.lit("Nobody").alias("name"), F.lit(5).alias("orderindex")),
                F.struct(F.lit("y").alias("id"), service.alias("name"), F.lit(6).alias("orderindex")),
            ),
        ),
        _field("Quality Score", "number", F.lit("3")),
        _field("Quality Score", "number", quality),
        _field(
            "Custom Sprints",
            "drop_down",
            F.lit("0"),
            _options([f"Sprint {n:02d}" for n in range(1, SPRINT_OPTIONS + 1)]),
        ),
    )
    ms = (F.unix_date(day).cast("bigint") * F.lit(86400000)).cast("string")
    later = ((F.unix_date(day) + F.lit(10)).cast("bigint") * F.lit(86400000) - F.lit(1)).cast("string")
    return [
        *(of(c).alias(c) for c in ("id", "name", "description")),
        F.struct(status.alias("status")).alias("status"),
        F.struct(of("priority_id").alias("id"), priority.alias("priority")).alias("priority"),
        F.struct(list_name(day).alias("name")).alias("list"),
        of("points").cast("double").alias("points"),
        ms.alias("start_date"),
        F.when(key % 3 != 0, later).alias("due_date"),
        F.when(key % 3 == 1, F.lit("12x")).alias("date_closed"),
        F.when(key % 3 == 2, later).alias("date_done"),
        ms.alias("date_created"),
        later.alias("date_updated"),
        F.when(key % 12 == 11, F.array().cast(schemas.ASSIGNEES))
        .otherwise(F.array(user))
        .alias("assignees"),
        fields.alias("custom_fields"),
    ]
