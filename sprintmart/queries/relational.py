"""Joins, duplicates, consolidation, set operations and sprint assignment."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart.functions.numbers import round_half_even
from sprintmart.operators import consolidate as con
from sprintmart.operators.dedup import duplicate_rows, split_by_repetition, unique_rows
from sprintmart.operators.joins import absent_from, left_lookup, look_up, not_in
from sprintmart.operators.skew import hot_keys, key_counts, left_fan_out, salted_join
from sprintmart.operators.sprints import (
    Calendar,
    Window,
    assign_sprint,
    current_sprint_rows,
    dim_sprint_key,
    sprint_index,
    sprint_label,
)
from sprintmart.queries import fixtures as fx
from sprintmart.queries.registry import Data, plain, query
from sprintmart.queries.scalars import SPRINT_OF_ORDER

# Rows from which a key counts as hot here, so that the test tables have hot keys at every scale.
FEW = 4
BUSY = 20

# --- joins ---------------------------------------------------------------------------------


@query(
    "left_fanout",
    """
select c_custkey, o_orderkey, l_linenumber, l_partkey, l_quantity
from customer left join orders on o_custkey = c_custkey
left join lineitem on l_orderkey = o_orderkey
""",
)
def left_fanout(d: Data) -> DataFrame:
    customers = d.customer.select("c_custkey")
    orders = d.orders.select("o_custkey", "o_orderkey")
    lines = d.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    bought = left_fan_out(customers, orders, "c_custkey", "o_custkey", hot_rows=FEW)
    return left_fan_out(bought, lines, "o_orderkey", "l_orderkey", hot_rows=FEW)


@query(
    "left_null_safe",
    """
select o_orderkey, c_name
from (select o_orderkey, case when o_custkey % 10 <> 3 then o_custkey end as k from orders) o
left join (select case when c_custkey <> 3 then c_custkey end as k, c_name from customer) c
  on o.k is not distinct from c.k
""",
)
def left_null_safe(d: Data) -> DataFrame:
    """One customer has no key, and the orders without a key match it."""
    orders = d.orders.select("o_orderkey", F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey")).alias("k"))
    customers = d.customer.select(F.when(F.col("c_custkey") != 3, F.col("c_custkey")).alias("ck"), "c_name")
    return left_lookup(orders, customers, "k", "ck", null_safe=True).drop("k")


@query(
    "left_missing_key",
    """
select o_orderkey, c_name
from (select o_orderkey, case when o_custkey % 3 <> 0 then o_custkey end as k from orders) o
left join (select case when c_custkey <> 3 then c_custkey end as k, c_name from customer) c
  on o.k = c.k
""",
)
def left_missing_key(d: Data) -> DataFrame:
    """A third of the orders has no key; they match nothing and are spread over the tasks."""
    present = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))
    # Whole numbers on one side, doubles on the other: equal numbers are equal keys.
    orders = d.orders.select("o_orderkey", present.cast("double").alias("k"))
    customers = d.customer.select(F.when(F.col("c_custkey") != 3, F.col("c_custkey")).alias("ck"), "c_name")
    return left_lookup(orders, customers, "k", "ck", spread_by="o_orderkey").drop("k")


@query(
    "left_hot_key",
    """
select event_id, event_type, e.user_id, c_name, c_mktsegment
from events e left join customer on c_custkey = user_id
""",
)
def left_hot_key(d: Data) -> DataFrame:
    """A lookup with its hot keys salted: here those of the busier users."""
    events = d.events.select("event_id", "event_type", "user_id")
    customers = d.customer.select("c_custkey", "c_name", "c_mktsegment")
    hot = hot_keys(key_counts(events, ["user_id"]), ["user_id"], BUSY)
    return salted_join(events, customers, [("user_id", "c_custkey")], "left", hot)


SPRINT_COUNT = 170


@query(
    "computed_key_join",
    f"""
select o_orderkey, '1995 - Sprint ' || cast({SPRINT_OF_ORDER} as varchar) as sprint,
       md5('dim_sprint~1995 - Sprint ' || cast({SPRINT_OF_ORDER} as varchar)) as sprint_uuid
from orders where {SPRINT_OF_ORDER} <= {SPRINT_COUNT}
""",
)
def computed_key_join(d: Data) -> DataFrame:
    sprints = Calendar.regular(fx.FIRST_DAY, SPRINT_COUNT).dimension(d.spark)
    label = sprint_label(sprint_index(F.col("o_orderdate"), fx.FIRST_DAY))
    keyed = d.orders.select("o_orderkey", dim_sprint_key(1995, label).alias("sprint"))
    return keyed.join(sprints, "sprint").withColumnRenamed("uuid", "sprint_uuid")


@query(
    "not_in_null_aware",
    """
with t as (select case when o_orderkey % 100 <> 7 then o_orderkey end as k from orders),
     clean as (select o_orderkey as f from orders where o_orderkey % 3 = 0),
     holed as (select case when f <> 9 then f end as f from clean),
     none as (select f from clean where f < 0)
select 'clean' as fact, k from t where k not in (select f from clean)
union all select 'holed', k from t where k not in (select f from holed)
union all select 'empty', k from t where k not in (select f from none)
""",
)
def not_in_null_aware(d: Data) -> DataFrame:
    """Against keys without a NULL, with one, and against no keys at all."""
    key = F.col("o_orderkey")
    tasks = d.orders.select(F.when(key % 100 != 7, key).alias("k"))
    clean = d.orders.filter(key % 3 == 0).select(key.alias("f"))
    holed = clean.select(F.when(F.col("f") != 9, F.col("f")).alias("f"))
    none = clean.filter("f < 0")
    parts = [
        not_in(tasks, keys, "k", "f").select(F.lit(name).alias("fact"), "k")
        for name, keys in (("clean", clean), ("holed", holed), ("empty", none))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "anti_join",
    """
select c_custkey, c_name from customer
where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'O'
                  and o_totalprice > 200000)
""",
)
def anti_join(d: Data) -> DataFrame:
    big = d.orders.filter("o_orderstatus = 'O' and o_totalprice > 200000")
    return absent_from(d.customer.select("c_custkey", "c_name"), big, {"c_custkey": "o_custkey"})


TEAM_INDEX = {f"NATION_{i}": i for i in range(20)}


@query(
    "dict_lookup",
    """
select c_custkey, case when n_nationkey < 20 then cast(n_nationkey as varchar) else 'Unknown' end as team
from customer join nation on n_nationkey = c_nationkey
""",
)
def dict_lookup(d: Data) -> DataFrame:
    index = {name: str(i) for name, i in TEAM_INDEX.items()}
    named = d.customer.join(d.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", look_up(F.col("n_name"), index, "Unknown").alias("team"))


# --- calendar ------------------------------------------------------------------------------

# Windows of unequal length with a gap and days before the first and after the last.
IRREGULAR = Calendar(
    [
        Window(1, date(2024, 1, 2), date(2024, 1, 7), 2024),
        Window(2, date(2024, 1, 8), date(2024, 1, 20), 2024),
        Window(3, date(2024, 1, 23), date(2024, 1, 27), 2024),
    ]
)


@query(
    "sprint_assign",
    """
select event_id, label, list_name from events left join (values
  (timestamp '2024-01-02', timestamp '2024-01-08', 'Sprint 1', 'Sprint 1 - 2024'),
  (timestamp '2024-01-08', timestamp '2024-01-21', 'Sprint 2', 'Sprint 2 - 2024'),
  (timestamp '2024-01-23', timestamp '2024-01-28', 'Sprint 3', 'Sprint 3 - 2024'))
  w(a, b, label, list_name) on ts >= a and ts < b
""",
)
def sprint_assign(d: Data) -> DataFrame:
    rows = d.events.select("event_id", "ts")
    return assign_sprint(rows, "ts", IRREGULAR, ("label", "list_name")).drop("ts")


# Windows of very different lengths that overlap, lie in one another and leave gaps: the smallest number holds.
OVERLAPPING = Calendar(
    [
        Window(5, date(1700, 1, 1), date(1995, 3, 31), 1995),
        Window(2, date(1993, 2, 1), date(1993, 5, 31), 1993),
        Window(4, date(1993, 5, 1), date(1994, 6, 30), 1993),
        Window(3, date(1994, 1, 1), date(1994, 1, 31), 1994),
        Window(1, date(1996, 1, 1), date(1996, 1, 1), 1996),
        Window(6, date(1997, 1, 1), date(2900, 1, 1), 1997),
    ]
)
_OVERLAPPING_SQL = ", ".join(f"({w.number}, date '{w.start}', date '{w.end}', '{w.dim_name}')" for w in OVERLAPPING.windows)


@query(
    "sprint_assign_bounds",
    f"""
select o_orderkey, min(w.n) as sprint_number, min_by(w.dim_name, w.n) as dim_name
from orders left join (values {_OVERLAPPING_SQL}) w(n, a, b, dim_name)
  on cast(o_orderdate as date) between w.a and w.b
group by o_orderkey
""",
)
def sprint_assign_bounds(d: Data) -> DataFrame:
    rows = d.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return assign_sprint(rows, "day", OVERLAPPING, ("sprint_number", "dim_name")).drop("day")


@query(
    "sprint_assign_arith",
    "select event_id, (cast(ts as date) - date '2023-12-25') // 14 + 1 as sprint from events",
)
def sprint_assign_arith(d: Data) -> DataFrame:
    return d.events.select("event_id", sprint_index(F.col("ts"), date(2023, 12, 25)).alias("sprint"))


TODAY = date(1997, 6, 15)


@query(
    "current_sprint_rows",
    f"""
select cast(o_orderkey as varchar) as id, 'Sprint 65 - 1995' as list_name, cast(65 as bigint) as sprint_number
from orders where {SPRINT_OF_ORDER} = 65
""",
)
def current_sprint(d: Data) -> DataFrame:
    """The nested task rows that mention the sprint of a given day in any column."""
    calendar = Calendar.regular(fx.FIRST_DAY, SPRINT_COUNT)
    found = current_sprint_rows(fx.task_records(d), calendar, TODAY)
    return found.select("id", F.col("list.name").alias("list_name"), "sprint_number")


# --- consolidation -------------------------------------------------------------------------


def records(d: Data) -> DataFrame:
    """Orders as records that share their customer's key."""
    return d.orders.select(
        F.col("o_custkey").alias("task_id"),
        F.col("o_orderkey").alias("ord"),
        F.col("o_orderpriority").alias("task_name"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("team"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("due_date"),
        F.col("o_totalprice").alias("monthly_revenue"),
        F.when(F.col("o_orderstatus") == "O", "active").otherwise("cancelled").alias("status"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey")).alias("term"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("currency"),
    )


RECORDS = """
select o_custkey as task_id, o_orderkey as ord, o_orderpriority as task_name,
       case when o_orderkey % 3 = 0 then o_orderstatus end as team,
       cast(o_orderdate as date) as start_date, cast(o_orderdate as date) + 30 as due_date,
       o_totalprice as monthly_revenue,
       case when o_orderstatus = 'O' then 'active' else 'cancelled' end as status,
       case when o_orderkey % 4 <> 0 then o_orderkey end as term,
       case when o_orderkey % 2 = 0 then o_orderpriority end as currency from orders
"""
EARLIEST = "min(start_date) as start_date, max(due_date) as due_date"
SUMS = "round_even(coalesce(sum(monthly_revenue) filter (status = 'active'), 0) * 100, 0) / 100 as monthly_revenue"
JOINED = """
coalesce(string_agg(distinct task_name, ';' order by task_name), '') as task_name,
coalesce(string_agg(distinct team, ';' order by team), '') as team
"""
STATUS = "case when bool_or(status = 'active') then 'active' else 'inactive' end as status"
FIRST = """
(array_agg(currency order by ord))[1] as currency,
arg_min(term, ord) filter (term is not null) as term
"""


def grouped(*aggregates: str) -> str:
    return f"select task_id, {', '.join(aggregates)} from ({RECORDS}) group by task_id"


def per_key(d: Data, **aggregates: Column) -> DataFrame:
    return records(d).groupBy("task_id").agg(*[a.alias(n) for n, a in aggregates.items()])


@query("consolidate_dates", grouped(EARLIEST))
def consolidate_dates(d: Data) -> DataFrame:
    return per_key(d, start_date=con.earliest_of("start_date"), due_date=con.latest_of("due_date"))


@query("consolidate_sums", grouped(SUMS))
def consolidate_sums(d: Data) -> DataFrame:
    total = con.sum_when("monthly_revenue", F.col("status") == "active")
    return per_key(d, monthly_revenue=round_half_even(total, 2))


@query("consolidate_concat", grouped(JOINED))
def consolidate_concat(d: Data) -> DataFrame:
    return per_key(d, task_name=con.joined_values("task_name"), team=con.joined_values("team"))


@query("consolidate_status", grouped(STATUS))
def consolidate_status(d: Data) -> DataFrame:
    return per_key(d, status=con.any_active(F.col("status") == "active"))


@query("consolidate_first", grouped(FIRST))
def consolidate_first(d: Data) -> DataFrame:
    order = F.col("ord")
    return per_key(
        d,
        currency=con.first_value("currency", order),
        term=con.first_present("term", order),
    )


ORDER_CONSOLIDATION = con.Consolidation(
    key="task_id",
    earliest=("start_date",),
    latest=("due_date",),
    sums=("monthly_revenue",),
    joined=("task_name", "team"),
    first=("currency",),
    first_present=("term",),
)


@query("consolidate", grouped(EARLIEST, SUMS, JOINED, STATUS, FIRST) + " having count(*) > 1")
def consolidate(d: Data) -> DataFrame:
    """All rules in one aggregation, for the keys that occur more than once."""
    merged = con.consolidate(records(d), ORDER_CONSOLIDATION, F.col("ord"), only_repeated=True)
    return merged.withColumn("monthly_revenue", round_half_even(F.col("monthly_revenue"), 2))


# --- duplicates, set operations, order -----------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINES = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from {lineitem}"
REPEATED = f"from (select *, count(*) over (partition by l_orderkey, l_linenumber) as n from ({plain(LINES)}))"


@query("dup_rows", f"select * exclude (n) {REPEATED} where n > 1")
def dup_rows(d: Data) -> DataFrame:
    return duplicate_rows(d.sql(LINES), LINE_KEY, hot_rows=3)


@query("unique_rows", f"select * exclude (n) {REPEATED} where n = 1")
def unique_rows_query(d: Data) -> DataFrame:
    return unique_rows(d.sql(LINES), LINE_KEY)


@query("union_all", plain(LINES))
def union_all(d: Data) -> DataFrame:
    """Unique and repeated rows put together again, by column name."""
    rows = split_by_repetition(d.sql(LINES), LINE_KEY)
    once, again = (rows.filter(test).drop("repeated") for test in ("not repeated", "repeated"))
    return once.unionByName(again.select(*reversed(once.columns)))


@query("sorted_output", plain(LINES) + " order by l_orderkey, l_linenumber, l_partkey")
def sorted_output(d: Data) -> DataFrame:
    """Sorted once, where the rows leave."""
    return d.sql(LINES).orderBy("l_orderkey", "l_linenumber", "l_partkey")
