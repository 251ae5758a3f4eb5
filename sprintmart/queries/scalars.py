"""Column functions over values derived from the test tables."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintmart.functions import dates, fields, numbers, text
from sprintmart.operators.sprints import (
    second_word_number,
    sprint_index,
    sprint_label,
    sprint_number,
    sprint_option,
)
from sprintmart.plans.staging import (
    constant,
    fill_missing,
    overwrite_when,
    project,
    task_fields,
)
from sprintmart.queries import fixtures as fx
from sprintmart.queries.registry import Data, plain, query

SPRINT_OF_ORDER = "(o_orderdate::date - date '1995-01-01') // 14 + 1"

# --- projections ---------------------------------------------------------------------------


@query(
    "project_rename",
    """
select cast(s_suppkey as varchar) as task_id, s_name as task_name, s_name as customer,
       n_name as team, s_acctbal as monthly_revenue
from supplier join nation on n_nationkey = s_nationkey
""",
)
def project_rename(d: Data) -> DataFrame:
    """One source column feeds two outputs; the nation key is dropped, the name renamed."""
    teams = d.nation.drop("n_regionkey").withColumnRenamed("n_name", "squad_name")
    joined = d.supplier.join(teams, F.col("n_nationkey") == F.col("s_nationkey"))
    return project(
        joined,
        [
            ("task_id", F.col("s_suppkey").cast("string")),
            ("task_name", "s_name"),
            ("customer", "s_name"),
            ("team", "squad_name"),
            ("monthly_revenue", "s_acctbal"),
        ],
    )


@query(
    "const_columns",
    """
select o_orderkey, cast(0 as double) as monthly_cost, cast(null as varchar) as list,
       cast(null as bigint) as term, true as is_active_register from orders
""",
)
def const_columns(d: Data) -> DataFrame:
    return d.orders.select(
        "o_orderkey",
        constant(0, "double").alias("monthly_cost"),
        constant(None, "string").alias("list"),
        constant(None, "bigint").alias("term"),
        constant(True, "boolean").alias("is_active_register"),
    )


@query(
    "import_stamp",
    """
select o_orderkey, date '2025-01-15' as import_date,
       timestamp '2025-01-15 22:32:00' as import_date_time,
       timestamp '2025-01-16 22:32:00' as expires from orders
""",
)
def import_stamp(d: Data) -> DataFrame:
    stamped = dates.import_stamp(d.orders.select("o_orderkey"), fx.RUN_TS)
    return stamped.withColumn("expires", dates.expires_at(F.col("import_date_time")))


@query(
    "conditional_overwrite",
    """
select o_orderkey, o_orderpriority,
       case when o_orderpriority = '1-URGENT' then 'U' else o_orderstatus end as o_orderstatus
from orders
""",
)
def conditional_overwrite(d: Data) -> DataFrame:
    rows = d.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return overwrite_when(rows, F.col("o_orderpriority") == "1-URGENT", "o_orderstatus", F.lit("U"))


@query(
    "fill_missing",
    """
select o_orderkey, case when o_orderkey % 3 = 0 then o_custkey else 0 end as owner,
       case when o_orderkey % 4 = 0 then o_totalprice else 0 end as price,
       case when o_orderkey % 5 = 0 then o_orderstatus else '0' end as status,
       coalesce(case when o_orderkey % 2 = 0 then true end, false) as flag
from orders
""",
)
def fill_missing_query(d: Data) -> DataFrame:
    key = F.col("o_orderkey")
    return fill_missing(
        d.orders.select(
            "o_orderkey",
            F.when(key % 3 == 0, F.col("o_custkey")).alias("owner"),
            F.when(key % 4 == 0, F.col("o_totalprice")).alias("price"),
            F.when(key % 5 == 0, F.col("o_orderstatus")).alias("status"),
            F.when(key % 2 == 0, F.lit(True)).alias("flag"),
        )
    )


# --- text ----------------------------------------------------------------------------------

PADDED = """
select o_orderkey,
       case when o_orderkey % 11 = 10 then cast(null as string) when o_orderkey % 11 = 9 then ''
            else chr(9) || chr(160) || ' ' || o_orderpriority || ' ' || o_orderstatus || chr(10)
                 || case when o_orderkey % 2 = 0 then chr(160) else '  ' end end as raw
from {orders}
"""


@query("trim_unicode", f"select o_orderkey, trim(raw, '{text.WHITESPACE}') as trimmed from ({plain(PADDED)})")
def trim_unicode(d: Data) -> DataFrame:
    return d.sql(PADDED).select("o_orderkey", text.trim_ws(F.col("raw")).alias("trimmed"))


# The same delimiters as a character class of the other engine's pattern language.
DELIMITER_CLASS = r"\s\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"


def initcap_sql(column: str) -> str:
    """The capitalisation as an expression of the other engine."""
    words = f"regexp_extract_all(lower({column}), '[^{DELIMITER_CLASS}]*[{DELIMITER_CLASS}]?')"
    return (
        f"case when {column} is not null then"
        f" array_to_string(list_transform({words}, lambda t: upper(t[1:1]) || t[2:]), '') end"
    )


PHRASES = """
select p_partkey as id,
       case when p_partkey % 13 = 12 then cast(null as string) when p_partkey % 13 = 11 then ''
            when p_partkey % 3 = 0 then upper(p_name) || '-' || p_type || '_x.y(z)'
            when p_partkey % 3 = 1 then p_brand || '  it''s ' || lower(p_type) || '/iN-progress'
            else chr(9) || p_name || ':' || p_type end as phrase
from {part}
"""


@query("initcap_delims", f"select id, {initcap_sql('phrase')} as title from ({plain(PHRASES)})")
def initcap_delims(d: Data) -> DataFrame:
    return d.sql(PHRASES).select("id", text.initcap_delims(F.col("phrase")).alias("title"))


@query(
    "upper_cols",
    "select event_id, upper(event_type) as event_type, upper(props) as props from events",
)
def upper_cols(d: Data) -> DataFrame:
    return d.events.select(
        "event_id", F.upper("event_type").alias("event_type"), F.upper("props").alias("props")
    )


@query(
    "value_map",
    """
select event_id, case event_type when 'view' then 'ON THE TEAM' when 'error' then 'LEFT THE TEAM'
       else event_type end as status from events
""",
)
def value_map(d: Data) -> DataFrame:
    mapping = {"view": "ON THE TEAM", "error": "LEFT THE TEAM"}
    return d.events.select("event_id", text.value_map(F.col("event_type"), mapping).alias("status"))


POLLUTED = """
select o_orderkey, case when o_orderkey % 5 = 0 then 'None' when o_orderkey % 5 = 1 then 'nan'
       when o_orderkey % 5 = 2 then cast(null as string) else o_orderpriority end as raw
from {orders}
"""


@query(
    "null_tokens",
    f"""
select o_orderkey, case when raw in ('None', 'nan') then null else raw end as cleaned
from ({plain(POLLUTED)})
""",
)
def null_tokens(d: Data) -> DataFrame:
    cleaned = text.null_tokens_to_null(F.col("raw"))
    return d.sql(POLLUTED).select("o_orderkey", cleaned.alias("cleaned"))


EXCLUDABLE = """
select p_partkey, case when p_partkey % 7 = 6 then cast(null as string)
       when p_partkey % 2 = 0 then upper(p_name) else p_name end as name from {part}
"""


@query(
    "exclude_pattern",
    f"""
select p_partkey, name from ({plain(EXCLUDABLE)})
where not coalesce(contains(lower(name), 'widget'), false)
""",
)
def exclude_pattern(d: Data) -> DataFrame:
    return d.sql(EXCLUDABLE).filter(text.lacks_text(F.col("name"), "Widget"))


@query(
    "any_column_match",
    r"""
select doc_id, contains(concat_ws(chr(1), doc_id, text, lang, source, n_chars), 'tion') as literal_hit,
       regexp_matches(concat_ws(chr(1), doc_id, text, lang, source, n_chars), 'src[13]|lic[ea]n') as regex_hit
from documents
where contains(concat_ws(chr(1), doc_id, text, lang, source, n_chars), 'tion')
   or regexp_matches(concat_ws(chr(1), doc_id, text, lang, source, n_chars), 'src[13]|lic[ea]n')
""",
)
def any_column_match(d: Data) -> DataFrame:
    docs = d.documents
    hits = docs.select(
        "doc_id",
        text.any_column_match(docs, "tion").alias("literal_hit"),
        text.any_column_match(docs, "src[13]|lic[ea]n", regex=True).alias("regex_hit"),
    )
    return hits.filter("literal_hit or regex_hit")


@query(
    "match_count",
    """
select lang, count(*) filter (contains(text, 'the ') or contains(source, 'src1')
       or contains(lang, 'the ')) as matches, count(*) as total
from documents group by lang
""",
)
def match_count(d: Data) -> DataFrame:
    docs = d.documents.select("text", "lang", "source")
    hit = text.any_column_match(docs.select("text"), "the ") | text.any_column_match(
        docs.select("source"), "src1"
    )
    return docs.groupBy("lang").agg(
        F.count_if(hit).alias("matches"), F.count(F.lit(1)).alias("total")
    )


# --- defaults, numbers ---------------------------------------------------------------------


@query(
    "ifnull_defaults",
    f"""
select id, coalesce(description, 'Undefined') as reviewer, coalesce(points, 0) as points,
       coalesce(priority = 'low', false) as flag from ({plain(fx.TASKS)})
""",
)
def ifnull_defaults(d: Data) -> DataFrame:
    return d.sql(fx.TASKS).select(
        "id",
        F.coalesce("description", F.lit("Undefined")).alias("reviewer"),
        F.coalesce("points", F.lit(0.0)).alias("points"),
        F.coalesce(F.col("priority") == "low", F.lit(False)).alias("flag"),
    )


SPELLED = """
select o_orderkey,
       case when o_orderkey % 9 = 0 then cast(o_orderkey as string) || '.0'
            when o_orderkey % 9 = 1 then ' ' || cast(o_orderkey as string) || ' '
            when o_orderkey % 9 = 2 then 'None' when o_orderkey % 9 = 3 then ''
            when o_orderkey % 9 = 4 then '-' || cast(o_orderkey as string)
            when o_orderkey % 9 = 5 then cast(null as string)
            when o_orderkey % 9 = 6 then cast(o_orderkey as string) || '1d'
            when o_orderkey % 9 = 7 then cast(o_orderkey % 40 as string) || '.5'
            else cast(o_orderkey as string) end as raw
from {orders}
"""
# The other engine's casts accept more spellings, hence the patterns.
WHOLE_SQL = "case when regexp_full_match(trim(raw), '[+-]?[0-9]+') then cast(trim(raw) as bigint) end"
NUMBER_SQL = r"case when regexp_full_match(trim(raw), '[+-]?[0-9]+(\.[0-9]+)?') then cast(trim(raw) as double) end"


@query("safe_cast_int", f"select o_orderkey, {WHOLE_SQL} as quality_score from ({plain(SPELLED)})")
def safe_cast_int(d: Data) -> DataFrame:
    return d.sql(SPELLED).select("o_orderkey", numbers.safe_int(F.col("raw")).alias("quality_score"))


@query(
    "to_numeric",
    f"""
select o_orderkey, {NUMBER_SQL} as value,
       cast(round_even(coalesce({NUMBER_SQL}, 0), 0) as bigint) as points,
       cast(case when {NUMBER_SQL} = floor({NUMBER_SQL}) then {NUMBER_SQL} end as bigint) as crm_id
from ({plain(SPELLED)})
""",
)
def to_numeric(d: Data) -> DataFrame:
    raw = F.col("raw")
    return d.sql(SPELLED).select(
        "o_orderkey",
        numbers.to_number(raw).alias("value"),
        numbers.whole_or_zero(raw).alias("points"),
        numbers.to_identifier(raw).alias("crm_id"),
    )


@query(
    "round_half_even",
    """
select o_orderkey, cast(round_even(o_orderkey / 2.0, 0) as bigint) as whole,
       round_even(cast(o_totalprice as double) / 8 * 100, 0) / 100 as money from orders
""",
)
def round_half_even(d: Data) -> DataFrame:
    return d.orders.select(
        "o_orderkey",
        numbers.to_whole(F.col("o_orderkey") / F.lit(2.0)).alias("whole"),
        numbers.round_half_even(F.col("o_totalprice") / F.lit(8.0), 2).alias("money"),
    )


@query(
    "yearly_to_monthly",
    f"""
select id, case when payment_frequency = 'Yearly' then cast(amount as double) / 12
       else cast(amount as double) end as amount from ({plain(fx.PURCHASES)})
""",
)
def yearly_to_monthly(d: Data) -> DataFrame:
    amount = numbers.to_number(F.col("amount"))
    monthly = numbers.monthly_amount(amount, F.col("payment_frequency"))
    return d.sql(fx.PURCHASES).select("id", monthly.alias("amount"))


@query(
    "parse_bool",
    f"select id, coalesce(growth_formula_implemented = 'true', false) as has_growth_formula from ({plain(fx.CUSTOMERS)})",
)
def parse_bool(d: Data) -> DataFrame:
    flag = numbers.to_bool(F.col("growth_formula_implemented"))
    return d.sql(fx.CUSTOMERS).select("id", flag.alias("has_growth_formula"))


# --- dates ---------------------------------------------------------------------------------

DAY_TEXT = """
select o_orderkey,
       case when o_orderkey % 10 = 0 then '31/02/2024' when o_orderkey % 10 = 1 then 'xx'
            when o_orderkey % 10 = 2 then 'None' when o_orderkey % 10 = 3 then cast(null as string)
            else substring(cast(cast(o_orderdate as date) as string), 9, 2) || '/'
                 || substring(cast(cast(o_orderdate as date) as string), 6, 2) || '/'
                 || substring(cast(cast(o_orderdate as date) as string), 1, 4) end as raw
from {orders}
"""


@query(
    "parse_br_date",
    f"""
select o_orderkey, cast(try_strptime(raw, '%d/%m/%Y') as date) as day,
       strftime(cast(try_strptime(raw, '%d/%m/%Y') as date), '%d/%m/%Y') as shown
from ({plain(DAY_TEXT)})
""",
)
def parse_br_date(d: Data) -> DataFrame:
    day = dates.parse_day_first(F.col("raw"))
    return d.sql(DAY_TEXT).select(
        "o_orderkey", day.alias("day"), dates.format_day_first(day).alias("shown")
    )


@query(
    "iso_date",
    f"""
select id, cast(try_strptime(service_end_date, '%Y-%m-%dT%H:%M:%SZ') as date) as end_day,
       cast(try_strptime(service_due_date, '%Y-%m-%d') as date) as due_day
from ({plain(fx.PURCHASES)})
""",
)
def iso_date(d: Data) -> DataFrame:
    return d.sql(fx.PURCHASES).select(
        "id",
        dates.iso_date(F.col("service_end_date")).alias("end_day"),
        dates.iso_date(F.col("service_due_date")).alias("due_day"),
    )


TWO_DAYS = """
select o_orderkey, case when o_orderkey % 3 <> 0 then cast(o_orderdate as date) end as a,
       case when o_orderkey % 4 <> 0 then date '1998-06-01' end as b from {orders}
"""


@query("greatest_date", f"select o_orderkey, greatest(a, b) as due_date from ({plain(TWO_DAYS)})")
def greatest_date(d: Data) -> DataFrame:
    return d.sql(TWO_DAYS).select("o_orderkey", dates.latest(F.col("a"), F.col("b")).alias("due_date"))


EPOCH_TEXT = """
select event_id, case when event_id % 10 = 0 then '12x' when event_id % 10 = 1 then '-5'
       when event_id % 10 = 2 then cast(null as string) when event_id % 10 = 3 then '99999999999999999999'
       else cast(1704067200000 + event_id * 3599999 as string) end as raw
from {events}
"""
EPOCH_SQL = "epoch_ms(case when regexp_full_match(raw, '[0-9]{1,15}') then cast(raw as bigint) end)"


@query(
    "epoch_ms_date",
    f"""
select event_id, cast({EPOCH_SQL} as date) as utc_day,
       cast({EPOCH_SQL} - interval 3 hour as date) as west_day,
       cast(timestamp '1970-01-01' + to_milliseconds(event_id * 1000000007) as date) as number_day
from ({plain(EPOCH_TEXT)})
""",
)
def epoch_ms_date(d: Data) -> DataFrame:
    """Etc/GMT+3 lies three hours west of UTC."""
    return d.sql(EPOCH_TEXT).select(
        "event_id",
        dates.epoch_ms_date(F.col("raw")).alias("utc_day"),
        dates.epoch_ms_date(F.col("raw"), "Etc/GMT+3").alias("west_day"),
        dates.epoch_ms_date((F.col("event_id") * F.lit(1000000007)).cast("double")).alias("number_day"),
    )


# --- sprint labels -------------------------------------------------------------------------

LABELS = """
select event_id, case when event_id % 10 = 9 then 'no label' when event_id % 10 = 8 then cast(null as string)
       else 'Sprint ' || cast(event_id % 120 as string) || ' - 2025' end as label from {events}
"""


@query(
    "sprint_number",
    rf"""
select event_id, try_cast(nullif(regexp_extract(label, 'Sprint (\d+)', 1), '') as bigint) as found,
       try_cast(nullif(split_part(label, ' ', 2), '') as bigint) as second from ({plain(LABELS)})
""",
)
def sprint_number_query(d: Data) -> DataFrame:
    return d.sql(LABELS).select(
        "event_id",
        sprint_number(F.col("label")).alias("found"),
        second_word_number(F.col("label")).alias("second"),
    )


@query(
    "sprint_label",
    """
select event_id, 'Sprint ' || cast(event_id % 120 as varchar) as label,
       'Sprint ' || case when event_id % 120 < 10 then '0' else '' end
         || cast(event_id % 120 as varchar) as option_name from events
""",
)
def sprint_label_query(d: Data) -> DataFrame:
    number = F.col("event_id") % 120
    return d.events.select(
        "event_id", sprint_label(number).alias("label"), sprint_option(number).alias("option_name")
    )


# --- arrays of structs ---------------------------------------------------------------------


@query("json_field", "select event_id, json_extract_string(props, '$.k') as k from events")
def json_field(d: Data) -> DataFrame:
    return d.events.select("event_id", fields.json_value(F.col("props"), "$.k").alias("k"))


CATEGORY_SQL = """
case when o_orderkey % 10 in (8, 9) or o_orderkey % 5 = 4 then null
     else ['Customer task', 'bug-fix', 'Data pipeline', 'improvement'][o_orderkey % 5 + 1] end
"""
CUSTOMER_SQL = """
case when o_orderkey % 7 <> 6 then 'Service ' || cast(o_orderkey as varchar) else 'Unknown Customer' end
"""
QUALITY_SQL = """
case when o_orderkey % 6 = 0 then '8.0' when o_orderkey % 6 < 4 then cast(o_orderkey % 10 as varchar) end
"""
MEMBER_NAME_SQL = "'Supplier#' || lpad(cast(o_custkey // 14 as varchar), 9, '0')"
USERNAME_SQL = f"case when o_orderkey % 12 <> 11 then ' ' || {MEMBER_NAME_SQL} end"
EMAIL_SQL = "case when o_orderkey % 12 <> 11 then 'user' || cast(o_custkey // 14 as varchar) || '@example.com' end"


@query(
    "option_lookup",
    f"""
select cast(o_orderkey as varchar) as id, {CATEGORY_SQL} as category, {CUSTOMER_SQL} as customer
from orders
""",
)
def option_lookup(d: Data) -> DataFrame:
    """Fields arrive as JSON text and are parsed first."""
    parsed = fields.parse_fields(F.to_json("custom_fields"))
    return fx.task_records(d).select("id", parsed.alias("f")).select(
        "id",
        fields.option_of_field(F.col("f"), "Agile Category").alias("category"),
        fields.option_of_field(F.col("f"), "Customer", "Unknown Customer").alias("customer"),
    )


@query(
    "first_assignee",
    f"""
select cast(o_orderkey as varchar) as id, {USERNAME_SQL} as username, {EMAIL_SQL} as email,
       case when o_orderkey % 12 <> 11 then o_custkey // 14 end as assignee_id from orders
""",
)
def first_assignee(d: Data) -> DataFrame:
    people = F.col("assignees")
    return fx.task_records(d).select(
        "id",
        fields.first_item(people, "username").alias("username"),
        fields.first_item(people, "email").alias("email"),
        fields.first_item(people, "id").alias("assignee_id"),
    )


@query(
    "task_fields",
    f"""
select cast(o_orderkey as varchar) as id, {MEMBER_NAME_SQL} as reviewer,
       {USERNAME_SQL} as assignee, {EMAIL_SQL} as email, {CATEGORY_SQL} as agile_category,
       {CUSTOMER_SQL} as customer, {QUALITY_SQL} as quality_score
from orders
""",
)
def task_fields_query(d: Data) -> DataFrame:
    return task_fields(fx.task_records(d)).select(
        "id", "reviewer", "assignee", "email", "agile_category", "customer", "quality_score"
    )


@query(
    "custom_field_update",
    f"""
select cast(o_orderkey as varchar) as id,
       case when {SPRINT_OF_ORDER} <= {fx.SPRINT_OPTIONS}
            then cast(({SPRINT_OF_ORDER} - 1) * 3 as varchar) else '0' end as chosen,
       '3' as untouched, 8 as n_fields
from orders
""",
)
def custom_field_update(d: Data) -> DataFrame:
    """The sprint's option is chosen by name, its index written, and one field appended."""
    sprint = sprint_index(F.timestamp_millis(F.col("start_date").cast("bigint")), fx.FIRST_DAY)
    updated = fields.choose_option(F.col("custom_fields"), "Custom Sprints", sprint_option(sprint))
    longer = fields.append_field(updated, F.get(F.col("custom_fields"), F.lit(0)))
    return fx.task_records(d).select("id", longer.alias("f")).select(
        "id",
        fields.scalar_of_field(F.col("f"), "Custom Sprints").alias("chosen"),
        F.get(fields.keep_fields(F.col("f"), "Quality Score"), F.lit(0))["value"].alias("untouched"),
        F.size("f").alias("n_fields"),
    )


@query(
    "array_filter_name",
    """
select cast(o_orderkey as varchar) as id, 2 as n, case when o_orderkey % 4 = 0 then '[]' end as last_value
from orders
""",
)
def array_filter_name(d: Data) -> DataFrame:
    kept = fields.keep_fields(F.col("custom_fields"), "Reviewer")
    return fx.task_records(d).select("id", kept.alias("f")).select(
        "id", F.size("f").alias("n"), F.get(F.col("f"), F.lit(1))["value"].alias("last_value")
    )
