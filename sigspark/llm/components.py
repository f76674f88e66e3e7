"""Connected components by alternating star contraction.

Each round is two aggregations and two joins over the edges that are left;
every round is landed, so nothing but two numbers reaches the driver. The hub
of a large component is split by the skew join, as both join sides are landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = land(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = land(down.groupBy("a").agg(F.min("b").alias("m")), "star")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for both ends of every edge (two columns of one
    ordered type); component is the least node reachable. Repeated and reversed
    edges are allowed; edges with a null end and self loops are ignored; no
    edges give no rows."""
    a, b = edges.columns
    now = land(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b"), "edges")
    mark = None
    while True:
        now = land(_small_star(land(_large_star(now), "large")), "small")
        got = now.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == tuple(got):
            break
        mark = tuple(got)
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
