"""Schemas of the landed JSON, the staging tables, the dimensions and the fact.

Fixed values: all field and column names below are those of the sources and of the published tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOL, DATE, TIMESTAMP = T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def strings(names: str) -> dict[str, T.DataType]:
    return {name: STRING for name in names.split()}


def page_of(**properties: T.DataType) -> T.StructType:
    """One landed search page whose results carry the given properties."""
    record = struct(
        id=STRING, createdAt=STRING, updatedAt=STRING, archived=BOOL, properties=struct(**properties)
    )
    return struct(results=T.ArrayType(record), paging=struct(next=struct(after=STRING)))


# --- landed JSON ---------------------------------------------------------------------------

MEMBER_PAGE = page_of(
    **strings(
        "member_name member_email member_status function capacity_points start_date"
        " departure_date manager modality hs_object_id hs_createdate hs_lastmodifieddate"
    )
)
TEAM_PAGE = page_of(squad_name=STRING)
CUSTOMER_PAGE = page_of(
    **strings(
        "customer_name customer_status growth_formula_implemented subscription_crm_id"
        " hs_createdate hs_lastmodifieddate"
    )
)
PURCHASE_PAGE = page_of(
    **strings(
        "hs_object_id amount discount gross_value mrr intermediation_fee payment_frequency"
        " payment_start_date payment_end_date service_name service_type service_status"
        " service_currency service_start_date service_end_date service_due_date"
        " sprint_points_plan subscription_service_plan slack_channel"
    )
)
ASSOCIATION_PAGE = struct(record_id=STRING, results=T.ArrayType(struct(id=STRING)))

_LIST = struct(id=STRING, name=STRING)
_FOLDER = struct(id=STRING, name=STRING, lists=T.ArrayType(_LIST))
_SPACE = struct(id=STRING, name=STRING, folders=T.ArrayType(_FOLDER))
WORKSPACE = struct(spaces=T.ArrayType(_SPACE))

OPTIONS = T.ArrayType(struct(id=STRING, name=STRING, orderindex=INT))
# ``value`` is polymorphic in the source and kept as its JSON text.
CUSTOM_FIELD = struct(id=STRING, name=STRING, type=STRING, value=STRING, type_config=struct(options=OPTIONS))
CUSTOM_FIELDS = T.ArrayType(CUSTOM_FIELD)
ASSIGNEES = T.ArrayType(struct(id=LONG, username=STRING, email=STRING))
TASK = struct(
    **strings("id name description"),
    status=struct(status=STRING),
    priority=struct(id=STRING, priority=STRING),
    list=struct(name=STRING),
    points=DOUBLE,
    **strings("start_date due_date date_closed date_done date_created date_updated"),
    assignees=ASSIGNEES,
    custom_fields=CUSTOM_FIELDS,
)
TASK_PAGE = struct(list_id=STRING, tasks=T.ArrayType(TASK))

# --- staging -------------------------------------------------------------------------------

_IMPORT = {"import_date": DATE, "import_date_time": TIMESTAMP}

STG_SQUAD = struct(
    **strings("task_id task_name position email"),
    capacity_points=DOUBLE,
    monthly_cost=DOUBLE,
    **strings("team slack_channel status list start_date due_date"),
    date_created=DATE,
    date_updated=DATE,
    **_IMPORT,
)
STG_CUSTOMER = struct(
    **strings("task_id task_name customer plan"),
    plan_points=LONG,
    currency=STRING,
    monthly_revenue=DOUBLE,
    term=LONG,
    start_date=DATE,
    go_live_date=DATE,
    last_renew_date=DATE,
    due_date=DATE,
    has_growth_formula=BOOL,
    **strings("slack_channel team"),
    crm_id=LONG,
    **strings("list temperature"),
    date_created=DATE,
    date_updated=DATE,
    chances_to_renew=STRING,
    renewal_term=LONG,
    **strings("status service_name"),
    **_IMPORT,
)
STG_SERVICE = struct(
    **strings("id customer service_name plan"),
    plan_points=LONG,
    **strings("service_type currency payment_frequency"),
    mrr=DOUBLE,
    term=LONG,
    **strings("status service_start_date service_end_date service_due_date"),
)
STG_TASK = struct(
    **strings("task_id task_name assignee reviewer priority category status"),
    points_estimate=LONG,
    points_estimate_rolled_up=LONG,
    start_date=DATE,
    due_date=DATE,
    date_closed=DATE,
    date_done=DATE,
    **strings("customer list sprint team"),
    date_created=DATE,
    date_updated=DATE,
    **strings("quality_score email"),
    **_IMPORT,
)

# --- dimensions and fact -------------------------------------------------------------------

DIM_CUSTOMER = struct(
    **strings("uuid external_id customer"),
    plan_points=LONG,
    start_date=DATE,
    due_date=DATE,
    has_growth_formula=BOOL,
    **strings("slack_channel team"),
    date_created=DATE,
    date_updated=DATE,
    is_active_register=BOOL,
    **strings("status service_name"),
    monthly_revenue=DOUBLE,
    **_IMPORT,
)
DIM_SQUAD = struct(
    **strings("uuid external_id member_name email position team"),
    capacity_points=DOUBLE,
    monthly_cost=DOUBLE,
    **strings("slack_channel status list"),
    start_date=DATE,
    due_date=DATE,
    date_created=DATE,
    date_updated=DATE,
    is_active_register=BOOL,
    **_IMPORT,
)
DIM_TASK = struct(
    **strings(
        "uuid task_id task_name sprint customer team assignee reviewer priority category status list"
    ),
    points_estimate=LONG,
    points_estimated_rolled_up=LONG,
    start_date=DATE,
    due_date=DATE,
    date_closed=DATE,
    date_done=DATE,
    date_created=DATE,
    date_updated=DATE,
    is_active_register=BOOL,
    quality_score=LONG,
    assignee_email=STRING,
    **_IMPORT,
)
DIM_SPRINT = struct(uuid=STRING, sprint=STRING)
FACT_SPRINT = struct(
    **strings("uuid sprint_uuid task_uuid customer_uuid squad_uuid"),
    points_estimate=LONG,
    points_estimated_rolled_up=LONG,
    points_done=LONG,
)
