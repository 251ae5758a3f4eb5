"""The three extracts over landed JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintmart.operators.joins import left_lookup
from sprintmart.operators.skew import left_fan_out
from sprintmart.sources.pages import bridge, existing_only, page_records
from sprintmart.sources.workspace import TreeRules, select_lists, tasks_of_lists


Keep = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, _: str) -> DataFrame:
    return df


def teams_extract(team_pages: DataFrame) -> DataFrame:
    return page_records(team_pages).select(F.col("id").alias("team_id"), "squad_name")


def squads_extract(
    member_pages: DataFrame, member_team_pages: DataFrame, team_pages: DataFrame, keep: Keep = _as_is
) -> tuple[DataFrame, DataFrame]:
    """(members with their teams, teams): one row per member and team, teamless members kept.

    ``keep`` may store the links, which are read twice, so that landed pages are parsed once.
    """
    teams = teams_extract(team_pages)
    members = page_records(member_pages)
    links = keep(
        existing_only(bridge(member_team_pages, "squad_id", "team_id"), teams, "team_id", "team_id"), "member_links"
    )
    linked = left_fan_out(members, links.withColumn("_member", F.col("squad_id")), "id", "_member")
    return left_lookup(linked, teams, "team_id", "team_id", spread_by="id"), teams


def customers_extract(
    customer_pages: DataFrame,
    customer_purchase_pages: DataFrame,
    purchase_pages: DataFrame,
    purchase_team_pages: DataFrame,
    teams: DataFrame,
    keep: Keep = _as_is,
) -> DataFrame:
    """Customers with their purchases and each purchase's teams, one row per combination.

    The associations may be many per record, so they are joined by ``left_fan_out``; records are
    looked up by their own id. ``keep`` may store the associations, which are read twice.
    """
    customers = page_records(customer_pages).drop(
        "archived", "customer_status", "hs_createdate", "hs_lastmodifieddate"
    )
    purchases = (
        page_records(purchase_pages)
        .drop("createdAt", "updatedAt", "archived", "hs_object_id")
        .withColumnRenamed("id", "purchase_id")
    )
    link = "associated_object_1_id"
    links = keep(bridge(customer_purchase_pages, "_customer", link), "purchase_links")
    linked = left_fan_out(customers, links, "id", "_customer")
    bought = left_lookup(
        linked, purchases.withColumn("_found", F.col("purchase_id")), link, "purchase_id", spread_by="id"
    )
    # Only a delivered purchase has teams.
    purchase_teams = keep(bridge(purchase_team_pages, "_purchase", "team_id"), "team_links")
    staffed = left_fan_out(bought, purchase_teams, "_found", "_purchase")
    return left_lookup(staffed, teams, "team_id", "team_id", spread_by="id").drop("team_id", "_found")


def tasks_extract(workspace: DataFrame, task_pages: DataFrame, rules: TreeRules) -> DataFrame:
    return tasks_of_lists(task_pages, select_lists(workspace, rules))
