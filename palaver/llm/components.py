"""Connected components of an edge list, as a loop of distributed steps.

Each round takes every node's neighbours to the least of them (large-star over greater neighbours,
small-star over lesser ones). The edges turn into stars around each component's least node in a
number of rounds that grows with the logarithm of the component's size. A round is stored in the
shared folder, so lineage stays short; no edge comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    # Both sides are dealt by the same key by Spark itself, which may then split a hub's rows over tasks.
    return both.where("b > a").join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: columns a, b (long). Returns node, root (the least node of its component) for all nodes but the roots."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = mark(now)
    while True:
        then = stored(_small_star(_large_star(now)))
        drop_stored(now)
        now, last, seen = then, seen, mark(then)
        if seen == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
