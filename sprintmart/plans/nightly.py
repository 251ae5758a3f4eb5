"""The nightly run: extracts, staging, dimensions, fact, write-back payload."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sprintmart.operators.fact import fact_new_rows
from sprintmart.operators.history import TeamField, history_payload
from sprintmart.operators.scd2 import (
    Scd2Result,
    Scd2Spec,
    Stage,
    by_team,
    consolidated_customer_spec,
    customer_spec,
    matching_new_key,
    require_unique,
    scd2_parts,
    squad_spec,
    task_spec,
)
from sprintmart.operators.sprints import Calendar, assign_sprint, current_sprint_rows
from sprintmart.plans.extracts import customers_extract, squads_extract, tasks_extract
from sprintmart.plans.staging import REJECTS, counted, reject_rows, stg_customer, stg_service, stg_squad, stg_task
from sprintmart.plans.tables import Tables
from sprintmart.schemas import (
    ASSOCIATION_PAGE,
    CUSTOMER_PAGE,
    DIM_CUSTOMER,
    DIM_SQUAD,
    DIM_TASK,
    FACT_SPRINT,
    MEMBER_PAGE,
    PURCHASE_PAGE,
    TASK_PAGE,
    TEAM_PAGE,
    WORKSPACE,
)
from sprintmart.session import brief_shuffles, release_driver, require_utc, together
from sprintmart.sources.pages import read_pages, write_jsonl
from sprintmart.sources.workspace import TreeRules

DIMENSIONS = ("dim_customer", "dim_squad", "dim_task")
STAGES = ("stg_customer", "stg_service", "stg_squad", "stg_task", "stg_rejects", "dim_sprint")
REJECT_COUNTS = "reject_counts"
FACT_TABLE = "fat_sprint_detail"
PAYLOAD = "history_payload"


@dataclass(frozen=True)
class Landing:
    """The landed pages of one night."""

    members: DataFrame
    member_teams: DataFrame
    teams: DataFrame
    customers: DataFrame
    customer_purchases: DataFrame
    purchases: DataFrame
    purchase_teams: DataFrame
    workspace: DataFrame
    task_pages: DataFrame


def read_landing(spark: SparkSession, root: str) -> Landing:
    """The pages landed as JSON lines below ``root``, one folder per kind."""
    schemas_of = {
        "members": MEMBER_PAGE,
        "member_teams": ASSOCIATION_PAGE,
        "teams": TEAM_PAGE,
        "customers": CUSTOMER_PAGE,
        "customer_purchases": ASSOCIATION_PAGE,
        "purchases": PURCHASE_PAGE,
        "purchase_teams": ASSOCIATION_PAGE,
        "workspace": WORKSPACE,
        "task_pages": TASK_PAGE,
    }
    required = {"workspace": "spaces", "task_pages": "tasks"}
    return Landing(
        **{n: read_pages(spark, f"{root}/{n}", s, required.get(n, "results")) for n, s in schemas_of.items()}
    )


@dataclass(frozen=True)
class Settings:
    """Everything that differs between installations and runs."""

    run_ts: datetime
    today: date
    calendar: Calendar
    rules: TreeRules
    team_field: TeamField
    excluded_service: str | None = None
    tz: str = "UTC"
    sprint_field: str = "Custom Sprints"
    duplicates: str = "error"
    change: str = "import_date"
    team_key: bool = True
    matching_key: bool = False
    consolidate: bool = False
    services: bool = False
    year: int | None = None
    keep_days: int | None = None
    rejects: bool = True

    @property
    def tree_rules(self) -> TreeRules:
        """The rules with the current sprint's list, unless they name one themselves."""
        window = self.calendar.current(self.today)
        if self.rules.sprint_list is not None or window is None:
            return self.rules
        return replace(self.rules, sprint_list=window.list_name)

    @property
    def sprint_year(self) -> int:
        """The year in the sprint dimension's keys for a task imported outside all sprints."""
        if self.year is not None:
            return self.year
        window = self.calendar.current(self.today)
        return window.year if window is not None else self.run_ts.year

    def specs(self) -> tuple[Scd2Spec, Scd2Spec, Scd2Spec]:
        """How the customer, squad and task dimensions are kept."""
        if self.consolidate:
            # One row per customer holds all its teams.
            customer = consolidated_customer_spec()
        else:
            customer = matching_new_key(customer_spec()) if self.matching_key else customer_spec()
            customer = by_team(customer) if self.team_key else customer
        both = (squad_spec(), task_spec())
        return (customer, *(by_team(s) if self.team_key else s for s in both))


@dataclass(frozen=True)
class Previous:
    """The published tables the run starts from."""

    dim_customer: DataFrame
    dim_squad: DataFrame
    dim_task: DataFrame
    fact: DataFrame


@dataclass(frozen=True)
class Staged:
    customers: DataFrame
    squads: DataFrame
    tasks: DataFrame
    raw_tasks: DataFrame
    rejects: DataFrame | None = None
    counts: Mapping[str, Observation] = field(default_factory=dict)

    def rejected_counts(self) -> list[tuple[str, str, int]]:
        """(stage, field, rejected values) as counted by the writes of the stages; a row a checked column."""
        return [
            (name, column, n or 0)
            for name, seen in self.counts.items()
            for column, n in seen.get.items()
            if column != "rows"
        ]


@dataclass(frozen=True)
class Night:
    """What a run produces."""

    staged: Staged
    customer: Scd2Result
    squad: Scd2Result
    task: Scd2Result
    dim_sprint: DataFrame
    fact_rows: DataFrame
    payload: DataFrame


def _as_is(df: DataFrame, _: str) -> DataFrame:
    return df


def stage_all(landing: Landing, cfg: Settings, keep: Stage = _as_is) -> Staged:
    """Extract and clean the three sources."""
    members, teams = squads_extract(landing.members, landing.member_teams, landing.teams, keep)
    bought = customers_extract(
        landing.customers, landing.customer_purchases, landing.purchases, landing.purchase_teams, teams, keep
    )
    found = tasks_extract(landing.workspace, landing.task_pages, cfg.tree_rules)
    current = keep(current_sprint_rows(found, cfg.calendar, cfg.today), "raw_task")
    rejects: dict[str, DataFrame] = {}
    counts: dict[str, Observation] = {}

    def noted(stage: DataFrame, name: str) -> DataFrame:
        """Store a stage, with its rejected values counted in the same pass and read from what was stored."""
        if REJECTS not in stage.columns:
            return keep(stage, name)
        stage, counts[name] = counted(stage, name)
        stage = keep(stage, name)
        rejects[name] = reject_rows(stage, name)
        return stage.drop(REJECTS)

    squads = noted(stg_squad(members, cfg.run_ts, rejects=cfg.rejects), "stg_squad")
    merged = cfg.consolidate
    customers = stg_customer(
        bought, cfg.run_ts, cfg.excluded_service, merged, rejects=cfg.rejects and not merged
    )
    if cfg.services:
        keep(stg_service(bought), "stg_service")
    # A member of two teams gives a task of the customer's team two equal rows, which are one record.
    tasks = stg_task(current, squads, cfg.run_ts, cfg.tz, rejects=cfg.rejects).distinct()
    return Staged(
        customers=noted(customers, "stg_customer"),
        squads=squads,
        tasks=noted(tasks, "stg_task"),
        raw_tasks=current,
        rejects=reduce(DataFrame.unionByName, rejects.values()) if rejects else None,
        counts=counts,
    )


def run_night(
    landing: Landing,
    previous: Previous,
    cfg: Settings,
    keep: Stage | None = None,
    write: Callable[[Scd2Result, Scd2Spec], DataFrame] | None = None,
    staged_all: Callable[[], None] = lambda: None,
) -> Night:
    """One night.

    Without ``keep`` the result is a set of lazy plans. ``keep`` may store each named table and
    return it read back; every step then starts from stored rows and nothing is computed twice. ``write``
    stores a merge and returns the active rows, old and new; ``staged_all`` is called when all stages are stored,
    before the first table made of them.
    """
    stage, keep = keep, keep or _as_is
    require_utc(landing.members.sparkSession)
    staged = stage_all(landing, cfg, keep)
    if stage is not None and staged.rejects is not None:
        # One row a value that spells nothing; the counts came with the writes of the stages.
        keep(staged.rejects, "stg_rejects")
    specs = cfg.specs()
    if cfg.duplicates == "error":
        for stg, spec in zip((staged.customers, staged.squads, staged.tasks), specs):
            require_unique(stg, spec)
    staged_all()

    def merge(dim: DataFrame, stg: DataFrame, spec: Scd2Spec) -> tuple[Scd2Result, DataFrame]:
        merged = scd2_parts(dim, stg, spec, change=cfg.change, duplicates=cfg.duplicates, stage=stage)
        return merged, merged.written if write is None else write(merged, spec)

    dims = (previous.dim_customer, previous.dim_squad, previous.dim_task)
    stages = (staged.customers, staged.squads, staged.tasks)
    # The three merges read and write tables of their own.
    (customer, customers), (squad, squads), (task, tasks) = together(
        landing.members.sparkSession, *(partial(merge, *parts) for parts in zip(dims, stages, specs))
    )
    sprints = keep(cfg.calendar.dimension(landing.members.sparkSession), "dim_sprint")
    # A task belongs to the sprint of the day it was staged, in that sprint's own year. The rows
    # of this run carry the run's day, which near midnight is not the zone's.
    window = cfg.calendar.current(cfg.today)
    dated = assign_sprint(tasks, "import_date", cfg.calendar, ("label", "dim_name"))
    here = F.col("import_date_time") == F.lit(cfg.run_ts)
    own = F.when(F.col("label") == F.col("sprint"), F.col("dim_name"))
    if window is not None:
        own = F.when(here & (F.col("sprint") == window.label), F.lit(window.dim_name)).otherwise(own)
    named = dated.withColumn("_sprint_name", own)
    # Only active rows join the fact, so the untouched histories stay out of its plan.
    rows = fact_new_rows(
        named, sprints, customers, squads, previous.fact, cfg.sprint_year, sprint_name="_sprint_name"
    )
    payload = history_payload(staged.raw_tasks, staged.squads, cfg.team_field, sprint_field=cfg.sprint_field)
    return Night(
        staged, customer, squad, task, sprints, keep(rows, FACT_TABLE), keep(payload, PAYLOAD)
    )


def publish_night(landing: Landing, tables: Tables, cfg: Settings) -> Night:
    """One night, written below the tables' root.

    An error stops the run. Each table appears whole or not at all, and repeating the run under
    the same name overwrites what a stopped one left.
    """
    previous = Previous(
        dim_customer=tables.read_dimension("dim_customer", DIM_CUSTOMER),
        dim_squad=tables.read_dimension("dim_squad", DIM_SQUAD),
        dim_task=tables.read_dimension("dim_task", DIM_TASK),
        fact=tables.read_appended(FACT_TABLE, FACT_SPRINT),
    )

    stored: list[str] = []
    staged: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        rows = store(df, name)
        # A night is some eighty statements; the driver holds what the next step needs, not what all left.
        release_driver(tables.spark)
        return rows

    def store(df: DataFrame, name: str) -> DataFrame:
        if name in STAGES:
            staged.append(name)
            return tables.write_stage(df, name, commit=False)
        if name == FACT_TABLE:
            return tables.write_appended(df, name)
        if name == PAYLOAD:
            write_jsonl(df, tables.path(name, tables.run))
            return df
        stored.append(name)
        return tables.stage(df, name)

    def switch() -> None:
        tables.commit_stages(staged)
        staged.clear()

    def write(merged: Scd2Result, spec: Scd2Spec) -> DataFrame:
        schema = {"dim_customer": DIM_CUSTOMER, "dim_squad": DIM_SQUAD, "dim_task": DIM_TASK}[spec.table]
        active = tables.write_merge(merged, spec.table, spec.match_key[1], schema)
        release_driver(tables.spark)
        return active

    # Every step is stored and read back, so no later one needs the shuffles of an earlier one.
    with brief_shuffles(tables.spark):
        night = run_night(landing, previous, cfg, keep, write, switch)
        switch()
        counts = night.staged.rejected_counts()
        if counts:
            schema = "stage string, field string, n bigint"
            tables.write_appended(tables.spark.createDataFrame(counts, schema).coalesce(1), REJECT_COUNTS)
    tables.list_stages(stored)
    if cfg.keep_days is not None:
        tables.drop_expired(cfg.run_ts, cfg.keep_days, DIMENSIONS, STAGES)
    return night
