"""Landed pages, association bridges, the workspace tree, JSON lines, staging refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintmart import schemas
from sprintmart.plans.extracts import customers_extract, squads_extract, teams_extract
from sprintmart.plans.tables import Tables
from sprintmart.queries import fixtures as fx
from sprintmart.queries.registry import Data, plain, query
from sprintmart.session import scratch_dir
from sprintmart.sources.pages import (
    bridge,
    existing_only,
    flatten,
    flatten_open,
    page_records,
    parse_pages,
    read_jsonl,
    read_pages,
    write_jsonl,
)
from sprintmart.sources.workspace import TreeRules, select_lists


@query("page_explode", plain(fx.CUSTOMERS))
def page_explode(d: Data) -> DataFrame:
    """Pages landed as files, read with a fixed schema, one row per record."""
    properties = d.sql(fx.CUSTOMERS).columns[4:]
    path = scratch_dir(d.spark, "pages")
    fx.page_text(d.sql(fx.CUSTOMERS), properties).write.text(path)
    return page_records(read_pages(d.spark, path, schemas.CUSTOMER_PAGE))


@query(
    "bridge_explode",
    "select cast(o_custkey as varchar) as customer_id, cast(o_orderkey as varchar) as purchase_id from orders",
)
def bridge_explode(d: Data) -> DataFrame:
    text = fx.association_text(d.sql(fx.CUSTOMER_PURCHASES))
    pages = parse_pages(text, "page", schemas.ASSOCIATION_PAGE)
    return bridge(pages, "customer_id", "purchase_id")


@query(
    "bridge_semi",
    """
select cast(o_orderkey as varchar) as purchase_id, cast(o_custkey as varchar) as customer_id
from orders where exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)
""",
)
def bridge_semi(d: Data) -> DataFrame:
    links = bridge(fx.customer_purchase_pages(d), "customer_id", "purchase_id")
    delivered = d.customer.filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("id"))
    return existing_only(links, delivered, "customer_id", "id").select("purchase_id", "customer_id")


TREE = TreeRules(("AFRICA", "EUROPE"), "ASIA", "NATION_7", "Customer#000000107")


@query(
    "tree_filter",
    """
select nullif(r_name, 'AMERICA') as space, n_name as folder, cast(c_custkey as varchar) as list_id,
       c_name as list_name
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
where r_name not in ('AFRICA', 'EUROPE')
  and (r_name <> 'ASIA' or (n_name = 'NATION_7' and c_name = 'Customer#000000107'))
""",
)
def tree_filter(d: Data) -> DataFrame:
    """Spaces are regions, folders nations, lists customers; a document holds one page of lists. One
    space has no name."""
    item = F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    lists = (
        d.customer.withColumn("page", fx.page_number())
        .groupBy("c_nationkey", "page")
        .agg(F.collect_list(item).alias("lists"))
        .join(d.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(d.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    folder = F.struct(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), "lists"
    )
    space = F.struct(
        F.col("r_regionkey").cast("string").alias("id"),
        F.nullif(F.col("r_name"), F.lit("AMERICA")).alias("name"),
        F.array(folder).alias("folders"),
    )
    text = lists.select(F.to_json(F.struct(F.array(space).alias("spaces"))).alias("tree"))
    return select_lists(parse_pages(text, "tree", schemas.WORKSPACE), TREE)


@query(
    "json_flatten",
    """
select cast(o_orderkey as varchar) as id, o_orderstatus as properties_status,
       o_orderpriority as properties_priority_name, o_totalprice as properties_money_total,
       o_custkey as properties_owner_id from orders
""",
)
def json_flatten(d: Data) -> DataFrame:
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
            F.struct(F.col("o_totalprice").alias("total")).alias("money"),
            F.struct(F.col("o_custkey").alias("id")).alias("owner"),
        ).alias("properties"),
    )
    properties = schemas.struct(
        status=schemas.STRING,
        priority=schemas.struct(name=schemas.STRING),
        money=schemas.struct(total=schemas.DOUBLE),
        owner=schemas.struct(id=schemas.LONG),
    )
    schema = schemas.struct(id=schemas.STRING, properties=properties)
    return flatten(parse_pages(d.orders.select(F.to_json(record).alias("j")), "j", schema), "_")


@query(
    "json_flatten_open",
    """
select cast(o_orderkey as varchar) as id, o_orderstatus as properties_status,
       case when o_orderkey % 3 = 0 then o_orderpriority end as properties_priority_name,
       case when o_orderkey % 5 = 1 then o_custkey end as properties_owner_id,
       case when o_orderkey % 7 = 2 then o_orderkey % 2 = 0 end as properties_urgent,
       case when o_orderkey % 2 = 0 then '"' || o_orderstatus || '"' else cast(o_custkey as varchar) end as properties_mixed,
       cast(null as varchar) as properties_never
from orders
""",
)
def json_flatten_open(d: Data) -> DataFrame:
    """Documents whose fields no schema lists: some are in few documents, one is of two kinds, one is always null."""
    key = F.col("o_orderkey")
    some = lambda test, value: F.when(test, F.to_json(F.struct(value)))
    parts = F.array_compact(
        F.array(
            F.to_json(F.struct(F.col("o_orderstatus").alias("status"))),
            some(key % 3 == 0, F.struct(F.col("o_orderpriority").alias("name")).alias("priority")),
            some(key % 5 == 1, F.struct(F.col("o_custkey").alias("id")).alias("owner")),
            some(key % 7 == 2, (key % 2 == 0).alias("urgent")),
            F.when(key % 2 == 0, F.to_json(F.struct(F.col("o_orderstatus").alias("mixed"))))
            .otherwise(F.to_json(F.struct(F.col("o_custkey").alias("mixed")))),
            F.lit('{"never":null}'),
        )
    )
    # Several objects as one: their inner parts, joined.
    inner = F.array_join(F.transform(parts, lambda p: F.substring(p, F.lit(2), F.length(p) - 2)), ",")
    text = F.concat(F.lit('{"id":"'), key.cast("string"), F.lit('","properties":{'), inner, F.lit("}}"))
    return flatten_open(d.orders.select(text.alias("j")), "j", "_")


ORDERS_FLAT = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as o_day,
       case when o_orderkey % 3 = 0 then o_orderpriority end as priority
from {orders}
"""


@query("jsonl_roundtrip", plain(ORDERS_FLAT))
def jsonl_roundtrip(d: Data) -> DataFrame:
    rows = d.sql(ORDERS_FLAT)
    path = scratch_dir(d.spark, "jsonl")
    write_jsonl(rows, path)
    return read_jsonl(d.spark, path, rows.schema)


@query("stage_refresh", plain(ORDERS_FLAT))
def stage_refresh(d: Data) -> DataFrame:
    """Refreshed by two runs, held once: readers take the version that was committed last."""
    rows = d.sql(ORDERS_FLAT)
    root = scratch_dir(d.spark, "stage")
    for run in ("20250101T000000", "20250102T000000"):
        tables = Tables(d.spark, root, run)
        tables.write_stage(rows, "stg_order")
    return tables.read_stage("stg_order", rows.schema)


SQUADS_SQL = f"""
select m.id, m.createdAt, m.updatedAt, m.archived, m.member_name, m.member_email,
       m.member_status, m.function, m.capacity_points, m.start_date, m.departure_date, m.manager,
       m.modality, m.hs_object_id, m.hs_createdate, m.hs_lastmodifieddate,
       case when l.record is not null then m.id end as squad_id,
       cast(l.linked as varchar) as team_id, l.n_name as squad_name
from ({plain(fx.MEMBERS)}) m
left join (select record, linked, n_name from ({plain(fx.MEMBER_TEAMS)}) b
           join nation on n_nationkey = linked) l on cast(l.record as varchar) = m.id
"""


@query("squads_extract", SQUADS_SQL)
def squads(d: Data) -> DataFrame:
    return squads_extract(fx.member_pages(d), fx.member_team_pages(d), fx.team_pages(d))[0]


CUSTOMERS_SQL = f"""
select c.id, c.createdAt, c.updatedAt, c.customer_name, c.growth_formula_implemented,
       c.subscription_crm_id, cast(b.linked as varchar) as associated_object_1_id,
       p.amount, p.discount, p.gross_value, p.mrr, p.intermediation_fee, p.payment_frequency,
       p.payment_start_date, p.payment_end_date, p.service_name, p.service_type,
       p.service_status, p.service_currency, p.service_start_date, p.service_end_date,
       p.service_due_date, p.sprint_points_plan, p.subscription_service_plan, p.slack_channel,
       n.n_name as squad_name
from ({plain(fx.CUSTOMERS)}) c
left join ({plain(fx.CUSTOMER_PURCHASES)}) b on cast(b.record as varchar) = c.id
left join ({plain(fx.PURCHASES)}) p on p.id = cast(b.linked as varchar)
left join ({plain(fx.PURCHASE_TEAMS)}) t on cast(t.record as varchar) = p.id
left join nation n on n.n_nationkey = t.linked
"""


def customers(d: Data) -> DataFrame:
    teams = teams_extract(fx.team_pages(d))
    return customers_extract(
        fx.customer_pages(d),
        fx.customer_purchase_pages(d),
        fx.purchase_pages(d),
        fx.purchase_team_pages(d),
        teams,
    )


@query("customers_extract", CUSTOMERS_SQL)
def customers_query(d: Data) -> DataFrame:
    return customers(d)
