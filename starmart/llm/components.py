"""Connected components over an edge table, by alternating large-star and small-star steps.

Each round is two aggregates and two equi-joins over the remaining edges,
written to the shared folder; rounds grow with the logarithm of the longest
path.  Nothing is gathered on the driver but one count and one checksum a
round.  The join of a high-degree node has a unique other side, so adaptive
execution can split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import materialize


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (a, b), a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    joined = large.join(low, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
        low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) that is not itself the root (smallest node) of its component."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sums) == mark or not sums[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(sums)
        now = materialize(_star(now), name)
