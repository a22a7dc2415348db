"""Connected components of an edge table, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notice_engine.session import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) longs -> (node, root): root is the smallest id of the node's component.

    Alternating large-star and small-star steps: every node links its neighbours to
    the smallest id around it, until the edges form stars. Each round is one
    aggregation and one join; hot nodes are aggregated before the shuffle and their
    joins may be split. The edges of every round are written, so a lost executor
    costs one round at most.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    while True:  # the number of rounds grows with the square of the logarithm of the nodes at most
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(low.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        # small star: each node links its smaller neighbours, and itself, to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "cc-edges")
        # stars: nobody is both a centre and a point, and every point has one centre
        nodes = after.select(F.col("a").alias("node"), F.lit(1).alias("point"), F.lit(0).alias("centre")).union(after.select("b", F.lit(0), F.lit(1)))
        done = nodes.groupBy("node").agg(F.sum("point").alias("points"), F.max("centre").alias("centre")).where("points + centre > 1").isEmpty()
        edges = after
        if done:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
