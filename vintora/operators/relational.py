"""Reusable DataFrame -> DataFrame steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintora.functions import col, has_text


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One whole row per key: the smallest by ``order``, NULL last.

    An aggregate, not a window: partial aggregation keeps one row per key and task.
    Order columns are compared inside a struct, so they must be comparable; use
    ``descending`` for numbers, dates and timestamps that should be the largest.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[part for c in order for part in (c.isNull(), c)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def descending(c) -> Column:
    """A value that sorts the other way round; NULL stays NULL."""
    c = col(c)
    return -F.unix_micros(c.cast("timestamp"))


def match_with_fallback(left: DataFrame, right: DataFrame, first: tuple[str, str],
                        second: tuple[str, str]) -> DataFrame:
    """Rows of ``left`` with a partner by the first key, else by the second; others dropped.

    ``right`` holds distinct pairs of both keys, and the first one is unique in it once reduced.
    Rows without a first key never reach its join, so they cannot gather in one partition.
    """
    named = left.filter(has_text(first[0]))
    keys = right.select(F.col(first[1]).alias("matched_key")).distinct()
    hit = named.join(keys, F.col(first[0]) == F.col("matched_key"))
    unmatched = named.filter(has_text(second[0])).join(
        right.select(F.col(first[1]).alias("_key")), F.col(first[0]) == F.col("_key"), "left_anti")
    keyless = left.filter(~F.coalesce(has_text(first[0]), F.lit(False)) & has_text(second[0]))
    missed = unmatched.unionByName(keyless)
    partners = right.select(F.col(second[1]).alias("_key"), F.col(first[1]).alias("matched_key"))
    rescued = missed.join(partners, F.col(second[0]) == F.col("_key")).drop("_key")
    return hit.unionByName(rescued)


def interval_lookup(facts: DataFrame, spans: DataFrame, key: str, at: Column, start: str, end: str,
                    columns: list[str]) -> DataFrame:
    """Left join to the span of the same key that holds the date: equal key, then a residual."""
    side = spans.select(F.col(key).alias("_key"), F.col(start).alias("_from"),
                        F.col(end).alias("_to"), *columns)
    on = (F.col(key) == F.col("_key")) & at.between(F.col("_from"), F.col("_to"))
    return facts.join(side, on, "left").drop("_key", "_from", "_to")


def islands(df: DataFrame, key: str, at: str, value: str, attributes: list[str]) -> DataFrame:
    """Runs of the same value per key in date order.

    Rows are first reduced to (key, day, value): a key then holds at most one row per day and
    value, so its window is bounded by the calendar and not by the number of observations.
    """
    from pyspark.sql import Window
    daily = (df.filter(F.col(value).isNotNull()).groupBy(key, at, value)
             .agg(F.count(F.lit(1)).alias("_n"), *[F.max(a).alias(a) for a in attributes]))
    in_order = Window.partitionBy(key).orderBy(at, value)
    previous = F.lag(value).over(in_order)
    changed = F.when(previous.isNull() | (previous != F.col(value)), 1).otherwise(0)
    run = F.sum("_changed").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (daily.withColumn("_changed", changed).withColumn("_run", run)
            .groupBy(key, value, "_run")
            .agg(*[F.max(a).alias(a) for a in attributes], F.min(at).alias("valid_from"),
                 F.max(at).alias("valid_to"), F.sum("_n").alias("days"))
            .drop("_run"))


def unpivot_steps(df: DataFrame, steps: Iterable[tuple[Column, ...]], names: tuple[str, ...]
                  ) -> DataFrame:
    """One output row per step; ``names`` label the values of each step."""
    cells = [F.struct(*[value.alias(name) for value, name in zip(step, names)]) for step in steps]
    return df.withColumn("_cell", F.explode(F.array(*cells))).select(
        *df.columns, *[F.col("_cell")[n].alias(n) for n in names])


def months(start: Column, end: Column) -> Column:
    """Array of month starts from start to end, both included; NULL if there are none."""
    begin, stop = F.trunc(start, "month"), F.trunc(end, "month")
    return F.when(begin <= stop, F.sequence(begin, stop, F.expr("INTERVAL 1 MONTH")))


def dates(start: Column, end: Column) -> Column:
    return F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def tail_from(sorted_values: Column, first) -> Column:
    """The part of a sorted array from the given member on."""
    start = F.array_position(sorted_values, col(first)).cast("int")
    return F.slice(sorted_values, start, F.size(sorted_values))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Grain assertion: stop the build if a key repeats."""
    sample = duplicates(df, keys).take(1)
    if sample:
        raise ValueError(f"{name}: {keys} is not unique, e.g. {sample[0].asDict()}")
    return df
