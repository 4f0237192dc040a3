"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _summary(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return found["n"], found["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable) for every node that has an edge.

    Edges are undirected; loops and repeated edges do no harm, edges with a null end are ignored. Minima are combined
    before each shuffle and joined back, so that a hub is split like any other skewed join key. Every round is written
    to the shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    ends = edges.select(F.col(a).cast("long").alias("p"), F.col(b).cast("long").alias("q"))
    known = ends.where("p <> q").select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct()
    known = materialise(known, "edges")
    before = _summary(known)
    while before[0]:
        both = known.union(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        across = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        known = materialise(across.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = _summary(known)
        if after == before:
            break
        before = after
    stars = known.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(known.select("v", "v").distinct())
