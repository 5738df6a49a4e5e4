"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored


def _with_least(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) with m, the least of u and all its v.

    A star's centre may hold any share of the arcs: the least is combined before the
    shuffle, and the join back has one row for each u, so skewed parts of arcs can be split.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("least"))
    return arcs.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the least node that can be reached.

    Each round is cut with a checkpoint; rounds grow with the logarithm of the longest chain.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter("u <> v").distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        joined = _with_least(large)
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = stored(small)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
