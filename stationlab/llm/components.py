"""Connected components of a graph given by its edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scale import durable
from .common import release


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a long, b long)``; the root is the component's smallest node.

    Large-star and small-star steps in turn: each hangs neighbours under smaller nodes until every component is a star.
    The edge table of a round is stored in the shared folder, so a lost executor costs one round at most; a round's work
    is in proportion to the edges, and a node with very many neighbours is split by the join like any skewed key. What a
    round leaves in the driver and in shuffle files goes before the next.
    """
    e = durable(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def mark(t):
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    before = mark(e)
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u and v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = durable(hung.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = mark(e)
        release(edges.sparkSession)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
