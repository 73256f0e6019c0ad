"""Connected components of an edge table of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (columns ``a`` and ``b``).

    ``component`` is the smallest id that can be reached. Each round hangs all neighbours of a node
    on the smallest of them; it ends when the edges form stars. Rounds grow with the logarithm of
    the longest path. Every round is written to the shared folder.
    """
    now = stored(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    while not _stars(now):
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("high"), F.least("u", "m").alias("low")))
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (large.join(least, "high").filter(F.col("low") != F.col("m"))
                 .select(F.col("low").alias("high"), F.col("m").alias("low"))
                 .unionByName(least.select("high", F.col("m").alias("low"))).distinct())
        now = stored(small, "edges")
    return (now.select(F.col("high").alias("id"), F.col("low").alias("component"))
            .unionByName(now.select(F.col("low").alias("id"), F.col("low").alias("component")))
            .distinct())


def _stars(edges: DataFrame) -> bool:
    """Every high end has one low end, and no low end is a high one."""
    ends = (edges.select(F.col("high").alias("id"), F.lit(1).alias("up"))
            .unionByName(edges.select(F.col("low").alias("id"), F.lit(0).alias("up")))
            .groupBy("id").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")))
    return ends.filter("up > 1 OR (up = 1 AND n > 1)").isEmpty()
