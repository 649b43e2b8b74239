"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filigree.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = edges.join(least, "u").select("m", F.explode(F.array("u", "v")).alias("u"))
    return ends.where("u <> m").select("u", F.col("m").alias("v")).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """True if every node has one parent and no parent has one."""
    child = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    parent = edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    seen = child.unionByName(parent).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` that has a link to another node.

    ``component`` is the smallest node reachable. Each round moves only links, never groups, and
    is written to the shared folder. Null ends, self-links and repeated links do not count; an
    empty table gives an empty table. Raises if ``rounds`` do not suffice (they grow with the
    logarithm of the longest path), since a partial result would be wrong.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(pairs.distinct())
    for _ in range(rounds):
        if _is_star_forest(edges):
            break
        edges = stage(_small_star(_large_star(edges)))
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
