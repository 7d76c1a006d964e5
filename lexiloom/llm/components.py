"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum with map-side combining, stored, and a join
with it: as both sides come from plain exchanges, Spark can split the large one
where a node has very many edges. Nothing but two numbers
per round reaches the driver. Each round is written to the shared work folder,
so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.session import settle


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free sum that tell whether a round has changed anything."""
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the node's least neighbour (itself included)."""
    both = edges.union(edges.select("b", "a"))
    least = settle(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
    return (both.join(least, both["a"] == least["u"]).where("b > a")
            .select(F.col("b").alias("a"), F.least("m", "u").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = settle(down.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")))
    others = down.join(least, down["u"] == least["w"]).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.union(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node but the roots.

    ``edges`` has columns a and b; self-loops and repeated edges are ignored, and
    no edges give no rows.
    """
    current = settle(edges.where("a <> b").select("a", "b").distinct())
    before = _mark(current)
    while before[0]:
        current = settle(_small_star(_large_star(current)))
        after = _mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
