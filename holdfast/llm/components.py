"""Connected components of an edge table, on Spark: alternating large and small stars.

No node's neighbours are gathered: a star step is a minimum per node (combined before the shuffle) and a join
with it, which adaptive skew handling can split at a hub. Rounds grow with the logarithm of the longest path;
the edges of each round are stored, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stored


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root that hangs on nothing."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b`` bigint; about ``rows`` if known); the root is the
    smallest node.

    Loops, repeated edges and edges with NULL are ignored; nodes without another edge do not appear.
    """
    now = stored(edges.filter(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                 "edges", rows)
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v")).filter("u != v").distinct())
        now = stored(small, "edges", now.count())
    # now every node hangs on its root alone
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct())
