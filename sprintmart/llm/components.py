"""Connected components of a distributed graph by alternating large and small stars.

Each round points every node at smaller neighbours until each component is a star around its smallest
node. Minima are pre-aggregated before the shuffle, and the joins that follow are plain ones,
so a node with very many neighbours is split by adaptive execution. Rounds grow with the logarithm of
a component's size. Nothing is collected but a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintmart.llm.stored import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    onward = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onward.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; ``edges`` has the columns u and v, in any
    direction and with repetitions. A component is named by its smallest node."""
    u, v = F.greatest("u", "v"), F.least("u", "v")
    state, now = None, stored(
        edges.where("u <> v").select(u.alias("u"), v.alias("v")).distinct(), "edges"
    )
    while (new := _state(now)) != state:
        state = new
        now = stored(_small_star(_large_star(now)).distinct(), "edges")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())
