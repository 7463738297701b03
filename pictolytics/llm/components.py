"""Connected components of an edge table, by stars that contract; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import landed


def _star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to the smallest one around it; edges point to the smaller end."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    large = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = joined.where("b <= a").select("a", F.col("m").alias("b"))
    return large.unionByName(own).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and itself, go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of all nodes that have an edge.

    ``edges`` has columns a, b; direction, repeats and loops do not matter. Every round is written to the
    shared folder; rounds grow with the logarithm of the largest component.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = landed(now, "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = landed(_small(_star(now)), "edges")
    own = now.groupBy("b").agg(F.col("b").alias("component")).select(F.col("b").alias("node"), "component")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
