"""Connected components of an undirected graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

PAIR = "u long, v long"


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); a component is named by its smallest node.

    Each round links the larger neighbours of a node to its smallest neighbour,
    then the smaller ones; the graph becomes one star per component in a number
    of rounds that grows with the logarithm of its size. A round aggregates
    before it shuffles and joins a hub's edges by sort-merge, which can be
    split. Rounds are written out, so a lost executor costs one round.
    """
    a, b = F.col("u").cast("long"), F.col("v").cast("long")
    links = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = stored(links, "links")
    before = _state(links)
    while before[0]:
        links = stored(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    member = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.unionByName(member.select(F.col("component").alias("node"), "component").distinct())


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(low, "u")
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
