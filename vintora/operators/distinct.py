"""Exact distinct counts whose margins come from the same cells.

Values are numbered densely once; a cell keeps the numbers of its values as bitmaps of 32,768 bits, one
per bucket of numbers that occurs in it. Bitmaps merge by OR, so the distinct count of any union of
cells, a margin or a total, is counted from the cells without going back to the facts, and no row is
copied per count. Partial bitmaps are built before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.operators.skew import number_rows


def dense_numbers(values: DataFrame, column: str, near: list[str] | None = None) -> DataFrame:
    """(column, number) of the distinct values that are not null, numbered from 1.

    Values with equal ``near`` columns (the smallest, if a value has several) get neighbouring
    numbers, so that cells along them fill few buckets.
    """
    near = near or []
    distinct = values.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.min(F.struct(*[F.col(c).alias(f"_n{i}") for i, c in enumerate(near)], F.lit(0).alias("_"))
              ).alias("_near"))
    flat = distinct.select(column, *[F.col(f"_near._n{i}").alias(f"_n{i}") for i in range(len(near))])
    return number_rows(flat, [*[f"_n{i}" for i in range(len(near))], column], "number").select(
        column, "number")


def bitmap_cells(df: DataFrame, cells: list[str], number: str) -> DataFrame:
    """(cells, bucket, bits): the numbers that occur in each cell; null numbers occur nowhere."""
    return (df.filter(F.col(number).isNotNull())
            .groupBy(*cells, F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")))


def margin(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, distinct): the distinct numbers of all cells that agree in ``keys``; without keys one row,
    0 for no cells."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("distinct"))


def margins(bitmaps: DataFrame, cells: list[str], levels: dict[str, list[str]]) -> DataFrame:
    """(level, cells, distinct): the margin of each level, cells outside its keys null."""
    kinds = {f.name: f.dataType for f in bitmaps.schema}
    parts = [margin(bitmaps, keys).select(
        F.lit(level).alias("level"),
        *[F.col(c) if c in keys else F.lit(None).cast(kinds[c]).alias(c) for c in cells], "distinct")
        for level, keys in levels.items()]
    return reduce(DataFrame.unionByName, parts)
