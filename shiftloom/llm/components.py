"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shiftloom.llm.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) from links (a, b).

    Alternates two steps until nothing changes: every neighbour above a node is linked to
    the smallest neighbour, then every neighbour below it. Minima are taken before rows
    meet, and each round's links are a table in the shared folder. A node that is linked
    only with itself is its own component and has no row.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    links = stored(links.distinct(), "links")
    state = None
    while True:
        seen = Observation()
        after = _small(_large(links)).observe(
            seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        )
        links = stored(after, "links")
        if seen.get == state:
            break
        state = seen.get
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(found.select("component", "component").distinct())


def _large(links: DataFrame) -> DataFrame:
    """Link the neighbours above a node, and the node, to the smallest neighbour or the node itself."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    up = links.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a", "left")
    moved = up.select(F.col("v").alias("a"), F.coalesce("m", "a").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _small(links: DataFrame) -> DataFrame:
    """Link the neighbours below a node, and the node, to the smallest of them.

    The window holds a node's smaller neighbours only. Many nodes may share a small
    neighbour, but that one is met as ``b``, never as ``a``.
    """
    least = links.withColumn("m", F.min("b").over(W.partitionBy("a")))
    pairs = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return least.select(F.inline(pairs)).filter("a != b").distinct()
