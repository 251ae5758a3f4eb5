"""Slowly changing (type 2) dimensions.

A run compares the staged rows with the active part of a dimension: rows staged by another import
are retired and inserted again, rows whose key the dimension lacks are inserted. All steps read
one frozen snapshot, and a re-inserted row is visible to the search for new ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintmart import schemas
from sprintmart.functions.dates import parse_day_first
from sprintmart.functions.keys import stable_id
from sprintmart.functions.numbers import safe_int
from sprintmart.functions.text import initcap_delims, trim_ws
from sprintmart.operators.joins import absent_from, left_lookup
from sprintmart.operators.skew import distinct_after_join

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Scd2Spec:
    """How one dimension is kept.

    ``match_key`` and ``new_key`` are (staged column, dimension column). ``values`` maps each
    dimension column, other than the id and the active flag, to an expression over the staged
    row. ``identity`` names the staged columns that, with the import instant, tell versions apart.
    """

    table: str
    match_key: tuple[str, str]
    new_key: tuple[str, str]
    new_probe: str
    stg_required: str
    new_required: str
    values: Mapping[str, Column]
    columns: Sequence[str]
    identity: Sequence[str]
    latest_by: str = "date_updated"
    dim_required: str | None = None
    reinsert_changed_only: bool = False
    tracked: Sequence[str] = ()
    with_team: bool = False


def _same(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _specs() -> tuple[Scd2Spec, Scd2Spec, Scd2Spec]:
    customer = Scd2Spec(
        table="dim_customer",
        match_key=("service_name", "service_name"),
        new_key=("task_id", "external_id"),
        new_probe="service_name",
        stg_required="customer",
        new_required="service_name",
        values={
            "external_id": F.col("task_id"),
            **_same("customer", "plan_points", "start_date", "due_date"),
            "has_growth_formula": F.coalesce(F.col("has_growth_formula"), F.lit(False)),
            **_same("slack_channel", "team", "date_created", "date_updated"),
            "status": initcap_delims(F.col("status")),
            **_same("service_name", "monthly_revenue", "import_date", "import_date_time"),
        },
        columns=tuple(schemas.DIM_CUSTOMER.fieldNames()),
        identity=("task_id", "service_name", "team"),
        tracked=("customer", "plan_points", "status", "monthly_revenue", "due_date", "team"),
    )
    squad = Scd2Spec(
        table="dim_squad",
        match_key=("email", "email"),
        new_key=("email", "email"),
        new_probe="member_name",
        stg_required="task_name",
        new_required="task_name",
        values={
            "external_id": F.col("task_id"),
            "member_name": trim_ws(F.col("task_name")),
            **_same("email", "position", "team", "capacity_points", "monthly_cost", "slack_channel"),
            "status": initcap_delims(F.col("status")),
            "list": F.col("list"),
            "start_date": parse_day_first(F.col("start_date"), strict=True),
            "due_date": parse_day_first(F.col("due_date"), strict=True),
            **_same("date_created", "date_updated", "import_date", "import_date_time"),
        },
        columns=tuple(schemas.DIM_SQUAD.fieldNames()),
        identity=("task_id", "email", "team"),
        tracked=("member_name", "position", "team", "capacity_points", "status", "due_date"),
    )
    task = Scd2Spec(
        table="dim_task",
        match_key=("task_id", "task_id"),
        new_key=("task_id", "task_id"),
        new_probe="task_name",
        stg_required="task_name",
        new_required="task_name",
        dim_required="task_name",
        reinsert_changed_only=True,
        values={
            **_same("task_id", "task_name", "sprint", "customer", "team"),
            "assignee": trim_ws(F.col("assignee")),
            "reviewer": F.coalesce(F.col("reviewer"), F.lit("Undefined")),
            "priority": initcap_delims(F.col("priority")),
            "category": initcap_delims(F.col("category")),
            "status": initcap_delims(F.col("status")),
            "list": F.col("list"),
            "points_estimate": F.coalesce(F.col("points_estimate"), F.lit(0).cast("bigint")),
            "points_estimated_rolled_up": F.coalesce(
                F.col("points_estimate_rolled_up"), F.lit(0).cast("bigint")
            ),
            **_same("start_date", "due_date", "date_closed", "date_done", "date_created", "date_updated"),
            "quality_score": safe_int(F.col("quality_score")),
            "assignee_email": F.col("email"),
            **_same("import_date", "import_date_time"),
        },
        columns=tuple(schemas.DIM_TASK.fieldNames()),
        identity=("task_id", "team"),
        tracked=("task_name", "status", "points_estimate", "assignee_email", "sprint", "customer"),
    )
    return customer, squad, task


def customer_spec() -> Scd2Spec:
    return _specs()[0]


def squad_spec() -> Scd2Spec:
    return _specs()[1]


def task_spec() -> Scd2Spec:
    return _specs()[2]


def matching_new_key(spec: Scd2Spec) -> Scd2Spec:
    """The same dimension with one key for both searches.

    With the customer's two different keys, a second service of a known customer is neither an
    update nor new; with this variant it is new.
    """
    return replace(spec, new_key=spec.match_key)


def consolidated_customer_spec() -> Scd2Spec:
    """The customer dimension for consolidated rows, which have no service name: the customer's id
    is the key of both searches."""
    key = ("task_id", "external_id")
    return replace(
        customer_spec(), match_key=key, new_key=key, new_probe="external_id", new_required="task_id",
        identity=("task_id",),
    )


def by_team(spec: Scd2Spec) -> Scd2Spec:
    """The same dimension with a chain of versions per key and team.

    The source hands out one row per team of a service or member, so several rows of a key are
    normal input; with the team in both keys each of them is a record of its own. A missing team
    is a team like any other.
    """
    return replace(spec, with_team=True)


_KEYS = ("_match", "_new")


def _with_keys(spec: Scd2Spec, rows: DataFrame, side: int) -> DataFrame:
    """Rows with the two keys as single columns; a missing key stays missing whatever the team."""
    for name, pair in zip(_KEYS, (spec.match_key, spec.new_key)):
        key = F.col(pair[side])
        both = F.to_json(F.struct(key.alias("k"), F.coalesce(F.to_json(F.array("team")), F.lit("")).alias("t")))
        rows = rows.withColumn(name, F.when(key.isNotNull(), both))
    return rows


def repeated_keys(stg: DataFrame, spec: Scd2Spec) -> DataFrame:
    """(key, n) of the keys that several rows of a stage have, required rows only."""
    if spec.with_team:
        stg = _with_keys(spec, stg, 0)
    key = _KEYS[0] if spec.with_team else spec.match_key[0]
    rows = stg.filter(F.col(spec.stg_required).isNotNull() & F.col(key).isNotNull())
    return rows.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique(stg: DataFrame, spec: Scd2Spec) -> None:
    """Raise if any key of a stage occurs twice, before anything is written."""
    found = repeated_keys(stg, spec).limit(5).collect()
    if found:
        shown = ", ".join(f"{r['key']} ({r['n']} rows)" for r in found)
        raise ValueError(f"{spec.table}: several staged rows for one key: {shown}")


def _stable_row(spec: Scd2Spec, replaced: Column) -> Column:
    parts = [F.col(c) for c in spec.identity]
    return stable_id(spec.table, *parts, F.unix_micros("import_date_time"), replaced)


def _insertable(spec: Scd2Spec, rows: DataFrame, replaced: Column) -> DataFrame:
    """Staged rows in the shape of the dimension, active, with their ids."""
    made: dict[str, Column] = dict(spec.values)
    made["uuid"] = _stable_row(spec, replaced)
    made["is_active_register"] = F.lit(True)
    return rows.select(*[made[c].alias(c) for c in spec.columns])


def _fingerprint(columns: Sequence[Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]))


def latest_per_key(stg: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One staged row per key, the latest by ``order``; rows without a key all stay.

    An aggregate rather than a ranking window: it is combined before the shuffle, so a key with
    very many copies does not end up in one task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in stg.columns])
    # NULL sorts first in a struct, and the row itself settles what the order leaves open.
    rank = F.struct(*[F.col(c) for c in order], row)
    best = (
        stg.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max_by(row, rank).alias("row"))
        .select("row.*")
    )
    return best.unionByName(stg.filter(F.col(key).isNull()))


def flag_changed(
    dim: DataFrame,
    stg: DataFrame,
    spec: Scd2Spec,
    change: str = "import_date",
    duplicates: str = "error",
) -> DataFrame:
    """The active dimension rows with ``_changed``: staged under the same key by another import.

    A missing import date on either side is no change. ``change='attributes'`` compares the
    tracked columns instead of the import date. Staged rows are reduced to one per key before the
    join, so they cannot multiply dimension rows; with ``duplicates='error'`` a changed row
    matched by several of them fails the job. None of them lacks the key, so the null-safe join
    matches no missing keys; it is what lets adaptive execution split a hot key of the dimension,
    because its hashed expression differs from the aggregate's.
    """
    staged_key, dim_key = spec.match_key
    active = dim.filter(F.col("is_active_register"))
    required = stg.filter(F.col(spec.stg_required).isNotNull() & F.col(staged_key).isNotNull())
    if change == "import_date":
        mark_stg, mark_dim = F.col("import_date"), F.col("import_date")
    elif change == "attributes":
        mark_stg = _fingerprint([spec.values[c] for c in spec.tracked])
        mark_dim = _fingerprint([F.col(c) for c in spec.tracked])
    else:
        raise ValueError(f"unknown change test {change!r}")
    per_key = required.groupBy(F.col(staged_key).alias("_staged_key")).agg(
        F.count(mark_stg).alias("_n"), F.min(mark_stg).alias("_lo"), F.max(mark_stg).alias("_hi")
    )
    joined = left_lookup(active, per_key, dim_key, "_staged_key", null_safe=True)
    differs = (F.col("_lo") != mark_dim) | (F.col("_hi") != mark_dim)
    if spec.dim_required:
        differs = differs & F.col(spec.dim_required).isNotNull()
    changed = F.coalesce(differs, F.lit(False))
    if duplicates == "error":
        message = F.concat(
            F.lit(f"{spec.table}: several staged rows for key "), F.col(dim_key).cast("string")
        )
        changed = F.when(changed & (F.col("_n") > 1), F.raise_error(message).cast("boolean")).otherwise(changed)
    return joined.withColumn("_changed", changed).drop("_n", "_lo", "_hi")


def changed_rows(flagged: DataFrame, spec: Scd2Spec) -> DataFrame:
    """The rows to replace: id, natural key and import date."""
    key = spec.match_key[1]
    return flagged.filter("_changed").select(
        F.col("uuid").alias("_replaced"), F.col(key).alias("_changed_key"), F.col("import_date").alias("_old_import")
    )


def tag_active(
    active: DataFrame,
    stg: DataFrame,
    spec: Scd2Spec,
    change: str = "import_date",
    duplicates: str = "error",
    plain_key: str | None = None,
) -> DataFrame:
    """What a merge needs to know of each active row: id, keys, whether it is to be replaced, and whether it makes a
    staged row known. One join of the active part with the stage, of which only these columns are read; every
    later step starts from this table. ``plain_key`` is the column that the dimension is laid out by."""
    flagged = flag_changed(active, stg, spec, change, duplicates)
    return flagged.select(
        F.col("uuid").alias("_replaced"),
        F.col(spec.match_key[1]).alias("_changed_key"),
        F.col("import_date").alias("_old_import"),
        F.col(plain_key or spec.match_key[1]).alias("_dim_key"),
        F.col(spec.new_key[1]).alias("_have"),
        F.col(spec.new_probe).isNotNull().alias("_seen"),
        "_changed",
    )


def retire(flagged: DataFrame) -> DataFrame:
    """The active rows after the update: the changed ones are inactive, the others unchanged."""
    return flagged.withColumn("is_active_register", ~F.col("_changed")).drop("_changed")


def retired_by_id(active: DataFrame, changed: DataFrame) -> DataFrame:
    """The same from the stored ids of the changed rows."""
    gone = changed.select(F.col("_replaced").alias("_gone")).distinct()
    rows = active.join(gone, F.col("uuid") == F.col("_gone"), "left")
    return rows.withColumn("is_active_register", F.col("_gone").isNull()).drop("_gone")


def reinsert(stg: DataFrame, changed: DataFrame, spec: Scd2Spec, change: str = "import_date") -> DataFrame:
    """The fresh versions: staged rows joined with the rows they replace."""
    test = F.col(spec.match_key[0]) == F.col("_changed_key")
    rows = stg
    if spec.reinsert_changed_only:
        rows = rows.filter(F.col(spec.stg_required).isNotNull())
        if change == "import_date":
            test = test & (F.col("import_date") != F.col("_old_import"))
    return _insertable(spec, rows.join(changed, test, "inner"), F.col("_replaced"))


def _seen(spec: Scd2Spec, rows: DataFrame) -> DataFrame:
    """The keys by which a staged row counts as known."""
    return rows.filter(F.col(spec.new_probe).isNotNull()).select(F.col(spec.new_key[1]).alias("_have"))


def unknown_rows(stg: DataFrame, seen: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Staged rows, still in their staged shape, whose key is not among ``seen``.

    The seen keys are first reduced to the staged ones: beside a small stage that is a broadcast,
    and the keys of a long history are scanned but not shuffled.
    """
    staged_key = spec.new_key[0]
    wanted = stg.filter(F.col(spec.new_required).isNotNull())
    staged = wanted.select(F.col(staged_key).alias("_staged"))
    have = distinct_after_join(seen.join(staged, F.col("_have") == F.col("_staged"), "left_semi"))
    return absent_from(wanted, have, {staged_key: "_have"}, left_skew=True, right_distinct=True)


@dataclass(frozen=True)
class Scd2Result:
    """One merge, in the parts a writer stores separately.

    ``current`` is the formerly active part, retired rows included; ``fresh`` and ``new`` are
    inserted; ``history`` is the inactive part nothing changes in, so no writer rewrites it. ``changed`` names the
    retired rows: id, match key, import date, and in a merge with stored steps the key of the dimension.
    """

    current: DataFrame
    fresh: DataFrame
    new: DataFrame
    history: DataFrame
    changed: DataFrame

    @property
    def written(self) -> DataFrame:
        return self.current.unionByName(self.fresh).unionByName(self.new)

    @property
    def dimension(self) -> DataFrame:
        return self.written.unionByName(self.history)


def scd2_parts(
    dim: DataFrame,
    stg: DataFrame,
    spec: Scd2Spec,
    change: str = "import_date",
    duplicates: str = "error",
    stage: Stage | None = None,
) -> Scd2Result:
    """The merge of a staged table into a dimension.

    ``stage`` may store a named intermediate table and return it read back. Those stored are the ones read twice: the
    tags of the active rows, the rows to re-insert, the rows unknown to the active part, and the new ones. The
    active part is then compared once, by its keys alone, and read in full only where it is written anew.
    """
    plain_key = spec.match_key[1]
    dim = dim.select(*spec.columns)
    if spec.with_team:
        dim, stg = _with_keys(spec, dim, 1), _with_keys(spec, stg, 0)
        spec = replace(spec, match_key=(_KEYS[0],) * 2, new_key=(_KEYS[1],) * 2, columns=(*spec.columns, *_KEYS),
                       values={**spec.values, **_same(*_KEYS)}, with_team=False)
        parts = _parts(dim, stg, spec, change, duplicates, stage, plain_key)
        return replace(parts, **{f: getattr(parts, f).drop(*_KEYS) for f in ("current", "fresh", "new", "history")})
    return _parts(dim, stg, spec, change, duplicates, stage, plain_key)


def _parts(
    dim: DataFrame, stg: DataFrame, spec: Scd2Spec, change: str, duplicates: str, stage: Stage | None, plain_key: str
) -> Scd2Result:
    if duplicates == "latest":
        stg = latest_per_key(stg, spec.match_key[0], [spec.latest_by])
    elif duplicates != "error":
        raise ValueError(f"unknown duplicate policy {duplicates!r}")
    active, history = _split(dim)
    if stage is None:
        flagged = flag_changed(dim, stg, spec, change, duplicates)
        changed = changed_rows(flagged, spec)
        fresh = reinsert(stg, changed, spec, change)
        current, near = retire(flagged), _seen(spec, active)
        keep: Stage = lambda df, _: df
    else:
        keep = stage
        tags = keep(tag_active(active, stg, spec, change, duplicates, plain_key), f"{spec.table}_tags")
        changed = tags.filter("_changed")
        fresh = keep(reinsert(stg, changed.drop("_have", "_seen", "_changed", "_dim_key"), spec, change), f"{spec.table}_need_updates")
        current, near = retired_by_id(active, changed), tags.filter("_seen").select("_have")
    # Few rows are unknown to the active part, so the history is compared with those only.
    candidates = keep(unknown_rows(stg, near.unionByName(_seen(spec, fresh)), spec), f"{spec.table}_candidates")
    new = _insertable(spec, unknown_rows(candidates, _seen(spec, history), spec), F.lit(""))
    return Scd2Result(current=current, fresh=fresh, new=keep(new, f"{spec.table}_new"), history=history, changed=changed)


def _split(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    active = F.coalesce(F.col("is_active_register"), F.lit(False))
    return dim.filter(active), dim.filter(~active)


def scd2_merge(dim: DataFrame, stg: DataFrame, spec: Scd2Spec, **options) -> DataFrame:
    """The dimension after the merge, as one plan."""
    return scd2_parts(dim, stg, spec, **options).dimension
