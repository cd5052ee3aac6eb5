"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one min-aggregation (combined before the shuffle) and one equi-join, so a hub with any number of
edges costs partial sums only; AQE splits the hub's side of the join. Every round is cut by a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import durable


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node points to one smaller node that points nowhere."""
    twice = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    inner = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return twice.select("a").union(inner.select("a")).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node that it reaches.

    Edges with a null end and loops are ignored; direction and repetition don't matter. Empty in, empty out."""
    now = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = durable(small.distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
