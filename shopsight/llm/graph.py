"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.tables import drop, save


def forest_roots(parents: DataFrame) -> DataFrame:
    """(node, root) for (node, parent), one row a node, where a parent is smaller than its node.

    Pointers are doubled until none can move, so a chain of n takes log2(n) joins.
    """
    now = save(parents.select("node", F.col("parent").alias("root")), "roots")
    while True:
        above = now.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = now.join(above, "root", "left")
        after = save(moved.select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        drop(now)
        now = after.select("node", "root")
        if after.filter("moved").isEmpty():
            return now


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    larger = near.filter(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (a, b) that is not the smallest of its component, that smallest.

    Alternates large-star and small-star steps until nothing changes. Minima are
    aggregated before they meet the links, so a node with very many links is no bottleneck.
    """
    now = save(links.filter("a <> b").distinct(), "links")
    state = _state(now)
    while True:
        after = save(_small_star(_large_star(now)), "links")
        drop(now)
        now, before, state = after, state, _state(after)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
