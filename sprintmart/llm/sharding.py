"""Sharding by fixed virtual slots with a versioned slot-to-shard map.

Records are hashed into ``SLOTS`` slots once and for all. Bytes and rows are added up per slot, and a
small table says which shard holds each slot. Rebalancing edits that table only: it moves slots from
the fullest shard to the emptiest one and appends the result as the next version, so a record moves
only if its slot does. The law that holds is ``bytes``: shard sizes are nearly equal.

The map has ``SLOTS`` rows however large the data, which is what the driver may hold of it; sizes are
pre-aggregated before they are shuffled. A slot takes its place in a shard behind the slots before
it, so positions need no window over a whole shard, only over one slot.

A null text is empty. Repeated rows (same id, same text) lie in one slot, next to one another; a null
id is a value like any other. An empty table gives no rows and a map of zeros.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096

_MAP = "version int, vslot int, shard int, bytes bigint, n_rows bigint, first bigint"


def text_size(text: str) -> Column:
    """UTF-8 bytes of a text, plus one for its end."""
    return (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long")


def text_crc32(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")))


def virtual_slot(key: list[str], slots: int = SLOTS) -> Column:
    """The slot of a record; the key decides alone."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_totals(records: DataFrame, slots: int = SLOTS) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot, of records with the columns vslot and size."""
    rows = records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    found = {r["vslot"]: (r["b"], r["n"]) for r in rows}
    return {slot: found.get(slot, (0, 0)) for slot in range(slots)}


def first_map(slots: int, shards: int) -> dict[int, int]:
    """Version 1, made before any sizes are known: slots in turn."""
    return {slot: slot % shards for slot in range(slots)}


def rebalance(current: dict[int, int], totals: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """The next version. Slots are moved one at a time from the fullest shard to the emptiest: the
    largest that is smaller than the gap between both, so each move narrows it; then slots are
    exchanged between these two while that helps. Deterministic, and stable where shards are even."""
    owner = dict(current)
    load = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in owner.items():
        load[shard] += totals[slot][0]
        held[shard].add(slot)

    def move(slot: int, to: int) -> None:
        held[owner[slot]].discard(slot)
        load[owner[slot]] -= totals[slot][0]
        owner[slot] = to
        held[to].add(slot)
        load[to] += totals[slot][0]

    for _ in range(4 * len(owner)):
        full = max(range(shards), key=lambda s: (load[s], -s))
        empty = min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        if gap <= 1:
            break
        # Half the gap is the ideal move; anything under the whole gap still narrows it.
        moves = [(abs(gap - 2 * totals[s][0]), s, None) for s in held[full] if 0 < totals[s][0] < gap]
        best = min(moves, key=lambda m: m[:2], default=(gap, -1, None))
        others = sorted((totals[s][0], s) for s in held[empty])
        sizes = [b for b, _ in others]
        for s in held[full]:
            want = totals[s][0] - gap // 2
            for k in _around(sizes, want):
                left = abs(gap - 2 * (totals[s][0] - sizes[k]))
                if (left, s) < best[:2]:
                    best = (left, s, others[k][1])
        if best[0] >= gap:
            break
        move(best[1], empty)
        if best[2] is not None:
            move(best[2], full)
    return owner


def _around(ordered: list[int], value: int) -> list[int]:
    """Indexes of the neighbours of a value in an ordered list."""
    at = bisect_left(ordered, value)
    return [k for k in (at - 1, at) if 0 <= k < len(ordered)]


def map_rows(version: int, owner: dict[int, int], totals: dict[int, tuple[int, int]]) -> list[tuple]:
    """Rows of one version; ``first`` is the position of a slot's first record in its shard."""
    place: dict[int, int] = {}
    out = []
    for slot in sorted(owner):
        shard = owner[slot]
        out.append((version, slot, shard, totals[slot][0], totals[slot][1], place.get(shard, 0)))
        place[shard] = place.get(shard, 0) + totals[slot][1]
    return out


def store_map(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append one version to the map table."""
    spark.createDataFrame(rows, _MAP).coalesce(1).write.mode("append").parquet(path)


def latest_map(spark: SparkSession, path: str) -> DataFrame:
    versions = spark.read.parquet(path)
    newest = versions.agg(F.max("version").alias("version"))
    return versions.join(F.broadcast(newest), "version")


def place(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Records with their shard and their gapless position ``slot`` in it. The map is broadcast: it has
    one row a virtual slot, whatever the data. Order inside a slot is by ``order``."""
    inside = F.row_number().over(Window.partitionBy("vslot").orderBy(*order)) - 1
    numbered = records.withColumn("inside", inside)
    chosen = F.broadcast(slot_map.select("vslot", "shard", "first"))
    return numbered.join(chosen, "vslot").withColumn("slot", (F.col("first") + F.col("inside")).cast("long")).drop(
        "first", "inside"
    )
