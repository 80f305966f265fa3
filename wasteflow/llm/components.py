"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_TASKS = 8
EDGES_PER_TASK = 50_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node with an edge to another. Ids must not be null.

    Every step writes its edges to the shared folder, so lineage stays short. The number of steps grows with the
    logarithm of the longest path.
    """
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    n = max(MIN_TASKS, -(-e.count() // EDGES_PER_TASK))  # no more tasks than the edges are worth
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low")).coalesce(n)
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).coalesce(n)
        low = large.groupBy("u").agg(F.min("v").alias("low")).coalesce(n)
        small = large.join(low.hint("merge"), "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).coalesce(n)
        e = materialize(small.unionAll(low.select("u", F.col("low").alias("v"))).distinct().coalesce(n), "edges")
        # Done when all components are stars: no node has two parents, or is both a child and a parent.
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(e.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).coalesce(n)
        if not ends.agg(F.count_if(F.expr("child > 1 or (child > 0 and parent > 0)"))).first()[0]:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select("v", "v").distinct())
