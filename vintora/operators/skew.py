"""Windows over keys of any size.

A plain window sends all rows of a key to one task. Here the rows are range-partitioned by (key,
order), so a range holds about as many rows as any other whatever the keys are, and written once
with the number of their range. Everything after reads those files, so all readers see the same
ranges, whatever the planner reuses and whichever executor is lost. Running sums and aggregates are
taken inside each range; a key that spans ranges gets what its other ranges add. A boundary splits
one key at most, so this correction has at most two rows per range, and that bound is what allows
it to be broadcast. The same plan serves every size; building it runs the job that writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.session import freeing_shuffles
from vintora.sources.load import scratch

RANGES = "spark.vintora.ranges"
_MERGE = {"min": F.min, "max": F.max, "sum": F.sum}


def _ranges(df: DataFrame) -> int:
    """As many ranges as other shuffles have partitions, unless set."""
    conf = df.sparkSession.conf
    return max(2, int(conf.get(RANGES, conf.get("spark.sql.shuffle.partitions"))))


def _sorted(names: list[str]) -> list[Column]:
    return [F.col(f"`{n[1:]}`").desc_nulls_last() if n.startswith("-")
            else F.col(f"`{n}`").asc_nulls_last() for n in names]


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows, written once in ranges of ``order``, and the number of their range, ``_range``.

    Every row of a range precedes every row of the next. Equal rows by ``order`` share a range.
    """
    path = scratch(df.sparkSession, "ranges")
    placed = df.repartitionByRange(_ranges(df), *_sorted(order)).withColumn(
        "_range", F.spark_partition_id())
    freeing_shuffles(df.sparkSession, lambda: placed.write.parquet(path))
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def keyed_window(df: DataFrame, keys: list[str], order: list[str], running: dict[str, Column],
                 overall: dict[str, tuple[str, Column]] | None = None) -> DataFrame:
    """Running sums (ROWS up to the current row) and whole-group ``min``, ``max`` or ``sum`` per key.

    ``order`` names columns, descending with a leading ``-``, nulls last; with the keys it must be
    a total order. Without keys the whole table is one group.
    """
    overall = overall or {}
    inputs = {f"_in_{n}": v for n, v in running.items()} | {
        f"_in_{n}": v for n, (_, v) in overall.items()}
    names = [f"_k{i}" for i in range(len(keys))]
    placed = in_ranges(df.withColumns(inputs), keys + order).withColumns(
        {n: F.col(f"`{k}`") for n, k in zip(names, keys)})
    parts = placed.groupBy("_range", *names).agg(
        *[F.sum(f"_in_{n}").alias(f"_part_{n}") for n in running],
        *[_MERGE[how](f"_in_{n}").alias(f"_part_{n}") for n, (how, _) in overall.items()])
    # One row per key and range from here on: what is sorted are ranges, not rows.
    every = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spanning = parts.select(
        F.col("_range").alias("_r"), *names, F.count(F.lit(1)).over(every).alias("_spans"),
        *[F.coalesce(F.sum(f"_part_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in running],
        *[_MERGE[how](f"_part_{n}").over(every).alias(f"_off_{n}")
          for n, (how, _) in overall.items()]).filter("_spans > 1").drop("_spans")
    here = Window.partitionBy("_range", *names)
    rows = here.orderBy(*_sorted(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns(
        {f"_run_{n}": F.coalesce(F.sum(f"_in_{n}").over(rows), F.lit(0)) for n in running}
        | {f"_all_{n}": _MERGE[how](f"_in_{n}").over(here) for n, (how, _) in overall.items()})
    on = F.col("_range") == F.col("_r")
    for name in names:
        on = on & local[name].eqNullSafe(spanning[name])
    out = local.join(F.broadcast(spanning), on, "left")
    return out.select(
        *[local[f"`{c}`"] for c in df.columns if c not in {*running, *overall}],
        *[(F.col(f"_run_{n}") + F.coalesce(f"_off_{n}", F.lit(0))).alias(n) for n in running],
        *[F.coalesce(f"_off_{n}", f"_all_{n}").alias(n) for n in overall])


def number_rows(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Global row number by ``order`` (a total order) without a one-task sort."""
    return keyed_window(df, [], order, {out: F.lit(1)})
