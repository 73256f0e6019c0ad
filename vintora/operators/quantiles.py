"""Exact percentiles of columns of any size, by selecting ranks instead of buffering values.

Values are counted first and the counts written in ranges of the value. The sums of the ranges tell
which of them hold the wanted ranks; only those are sorted inside, and only the values at those ranks
leave them. No task sees more than a range of distinct values, however many rows share one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.operators.skew import in_ranges


def rank_values(values: DataFrame, group: str, column: str, shares: list[float]) -> DataFrame:
    """(group, rows, maximum, share, lower, upper, weight): the values around each share's rank.

    The rank of share p is p * (rows - 1), counted from 0; the percentile lies ``weight`` of the way
    from ``lower`` to ``upper``. Null values count for nothing; a null group is a group.
    """
    counts = (values.filter(F.col(column).isNotNull())
              .groupBy(F.col(group).alias("g"), F.col(column).alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    placed = in_ranges(counts, ["g", "v"])
    parts = placed.groupBy("g", "_range").agg(F.sum("n").alias("n"), F.max("v").alias("top"))
    # One row per group and range.
    every = Window.partitionBy("g")
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    histogram = parts.select(
        "g", "_range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(every).alias("rows"), F.max("top").over(every).alias("maximum"))
    rank = F.col("share") * (F.col("rows") - 1)
    wanted = histogram.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumns(
        {"low": F.floor(rank), "high": F.ceil(rank), "weight": rank - F.floor(rank)})
    ends = wanted.withColumn("at", F.explode(F.array_distinct(F.array("low", "high")))).filter(
        (F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + F.col("n")))
    # Two ranks per group and share at most.
    ends = ends.select(F.col("g").alias("_g"), F.col("_range").alias("_r"), "start", "rows", "maximum",
                       "share", "low", "high", "weight", "at")
    hit = F.broadcast(ends.select("_g", "_r", "start").distinct())
    inside = Window.partitionBy("g", "_range").orderBy("v").rowsBetween(
        Window.unboundedPreceding, 0)
    same = placed["g"].eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))
    sorted_inside = (placed.join(hit, same).select("g", "_range", "v", "n", "start")
                     .withColumn("end", F.col("start") + F.sum("n").over(inside)))
    found = sorted_inside.drop("start").join(
        F.broadcast(ends), F.col("g").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))
        & (F.col("at") < F.col("end")) & (F.col("at") >= F.col("end") - F.col("n")))
    return found.groupBy(F.col("g").alias(group), "rows", "maximum", "share", "weight").agg(
        F.max(F.when(F.col("at") == F.col("low"), F.col("v"))).alias("lower"),
        F.max(F.when(F.col("at") == F.col("high"), F.col("v"))).alias("upper"))


def percentiles(values: DataFrame, group: str, column: str, shares: dict[str, float]) -> DataFrame:
    """One row per group: rows, maximum, and each share's percentile, interpolated, under its name."""
    around = rank_values(values, group, column, list(shares.values()))
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("weight")
    return around.groupBy(group).agg(
        F.max("rows").alias("rows"), F.max("maximum").alias("maximum"),
        *[F.max(F.when(F.col("share") == p, value)).alias(name) for name, p in shares.items()])
