"""Connected components by alternating large and small stars, each round written to the shared folder.

Nodes are numbers. Rows with a null end, and rows whose ends are equal, are no edges; repeated edges count once. No edges give an
empty result. A node may have any share of the edges: the joins of a round divide such nodes (`even_join`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import discard, even_join, stored


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links each larger neighbour of a node to the smallest of its neighbourhood. (links, the table they depend on)"""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return even_join(both.filter("v > u"), least.select("u", "m"), "u", least, F.col("v"), "inner").select(F.col("v").alias("u"), F.col("m").alias("v")), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    moved = even_join(edges, least.select("u", "m"), "u", least, F.col("v"), "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))), least


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for each node of an edge between two different nodes u > v, the smallest node it is connected to.

    Rounds end when no edge changes; as the stars' round count grows with the logarithm of the nodes, `max_rounds` is
    only a guard and raises an error.
    """
    now, seen = stored(edges.filter("u > v").distinct(), "edges"), None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        large, least = _large_star(now)
        middle = stored(large.distinct(), "stars")
        small, least_too = _small_star(middle)
        past, now = now, stored(small.distinct(), "stars")
        for table in (past, least, middle, least_too):
            discard(table)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
