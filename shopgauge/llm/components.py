"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for all nodes of edges (a, b), by alternating large and small stars.

    Every round hangs neighbours on the smallest node around; smallest nodes come from an aggregate and go back by a join, so a node
    with very many neighbours is no single task's work. Rounds are written to the checkpoint folder.
    """
    now = kept(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.unionByName(now.join(least, "a").where("a > m").select("a", F.col("m").alias("b"))).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        now = kept(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        seen = tuple(now.agg(F.count("*"), total).first())
        if seen == mark:
            break
        mark = seen
    found = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = now.select(F.col("b").alias("node")).distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(roots)
