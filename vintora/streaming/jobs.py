"""Stream forms of the windowed load and of the lag monitor."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vintora.functions import stamp
from vintora.operators.relational import descending, first_per_key
from vintora.sources.parts import DAY, PartedTable


def read_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


# -- changing rows ---------------------------------------------------------

@dataclass(frozen=True)
class Mutable:
    """What may change: a row inside the window of ``days``, or one whose status is not final.

    ``at`` is the creation time and never changes for a key; ``version`` orders its changes and is
    the event time of the stream, in which a change may arrive up to ``late`` days behind the newest.
    """

    key: str
    at: str
    version: str
    status: str
    final: tuple[str, ...]
    days: int
    late: int = 60


_SINCE = "first_batch"


def changing_table(spark: SparkSession, path: str, schema: str, rule: Mutable) -> PartedTable:
    """Rows by the month of their creation, with the batch that brought the key first."""
    return PartedTable(spark, path, f"{schema}, {_SINCE} BIGINT", F.col(rule.at))


def _clock(table: PartedTable, rule: Mutable, batch_id: int):
    """The newest creation time of earlier batches, from the last month that has one.

    A key keeps the number of its first batch, so a repeated batch sees the clock it saw before,
    whatever its first attempt has written.
    """
    for part in reversed(table.parts()):
        newest = table.read([part]).filter(F.col(_SINCE) < batch_id).agg(F.max(rule.at)).first()[0]
        if newest is not None:
            return newest
    return None


def apply_changes(table: PartedTable, rule: Mutable, batch: DataFrame, batch_id: int) -> None:
    """Merge a batch of changes into the months they belong to; repeated, it changes nothing.

    Taken are rows from the window before the clock, and older ones whose key is stored without a
    final status. Other months are neither read nor written.
    """
    batch = batch.persist()
    try:
        months = table.touched(batch)
        if not months:
            return
        newest_first = [descending(rule.version)]
        incoming = first_per_key(batch, [rule.key], newest_first)
        current = table.read(months)
        clock = _clock(table, rule, batch_id)
        known = current.select(rule.key, F.col(_SINCE).alias("_since"), (
            ~F.coalesce(F.col(rule.status).isin(*rule.final), F.lit(False))).alias("_open"))
        taken = incoming.join(known, rule.key, "left")
        if clock is not None:
            taken = taken.filter((F.col(rule.at) >= stamp(clock - dt.timedelta(days=rule.days)))
                                 | F.col("_open"))
        taken = taken.withColumn(_SINCE, F.coalesce("_since", F.lit(batch_id).cast("bigint")))
        taken = taken.select(*table.schema.names).persist()
        changed = table.touched(taken)
        if changed:
            merged = first_per_key(table.read(changed).unionByName(taken), [rule.key], newest_first)
            table.write(merged, changed)
        taken.unpersist()
    finally:
        batch.unpersist()


def upsert_stream(stream: DataFrame, table: PartedTable, rule: Mutable, checkpoint: str
                  ) -> StreamingQuery:
    """Each change once, however often it is sent: its key and version are stream state until the
    watermark has passed them."""
    # Event times have a zone in Spark; the tables' times have none.
    timed = stream.withColumn("_event", F.col(rule.version).cast("timestamp"))
    once = timed.withWatermark("_event", f"{rule.late} days").dropDuplicatesWithinWatermark(
        [rule.key, rule.version])
    return (once.drop("_event").writeStream
            .foreachBatch(lambda batch, batch_id: apply_changes(table, rule, batch, batch_id))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# -- lag -------------------------------------------------------------------

_HOURS = "source STRING, hour TIMESTAMP_NTZ, rows BIGINT, last_at TIMESTAMP_NTZ"
_TOTALS = "source STRING, arrived BIGINT, newest TIMESTAMP_NTZ"


@dataclass(frozen=True)
class LagTables:
    """``hours``: one row per source and hour of event time, by day. ``totals``: one per source."""

    hours: PartedTable
    totals: PartedTable

    @classmethod
    def at(cls, spark: SparkSession, path: str) -> "LagTables":
        path = path.rstrip("/")
        return cls(PartedTable(spark, f"{path}/hours", _HOURS, F.col("hour"), DAY),
                   PartedTable(spark, f"{path}/totals", _TOTALS, F.lit(None).cast("timestamp_ntz")))


def lag_streams(stream: DataFrame, tables: LagTables, checkpoint: str, source: str, at: str,
                late: str) -> list[StreamingQuery]:
    """Event-time hours per source, kept open until the watermark ``late`` behind the newest event
    has passed them, and beside them all that arrived per source.

    Both are aggregates in update mode: a batch hands over the current value of the rows it
    changed, so a repeated batch writes the same. What an hour no longer takes in is late: it is
    the difference between what arrived and what the hours hold.
    """
    # The name of the source is published; a missing one is a source of its own.
    events = stream.select(F.coalesce(F.col(source), F.lit("")).alias("source"),
                           F.col(at).cast("timestamp").alias("at"))
    hours = (events.withWatermark("at", late).groupBy("source", F.window("at", "1 hour"))
             .agg(F.count(F.lit(1)).alias("rows"), F.max("at").alias("last_at"))
             .select("source", F.col("window.start").cast("timestamp_ntz").alias("hour"), "rows",
                     F.col("last_at").cast("timestamp_ntz").alias("last_at")))
    totals = events.groupBy("source").agg(
        F.count(F.lit(1)).alias("arrived"), F.max("at").cast("timestamp_ntz").alias("newest"))

    def into(table: PartedTable, key: list[str], df: DataFrame, name: str) -> StreamingQuery:
        def merge(batch: DataFrame, _: int) -> None:
            rows = batch.persist()
            table.merge(rows, key)
            rows.unpersist()
        return (df.writeStream.outputMode("update").foreachBatch(merge)
                .option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())

    return [into(tables.hours, ["source", "hour"], hours, "hours"),
            into(tables.totals, ["source"], totals, "totals")]


def lag_status(tables: LagTables, now: dt.datetime) -> DataFrame:
    """Per source and hour the rows, the last event and its lag; per source the lamp (24 hours
    warn, 48 hours critical) and the late rows."""
    def hours_since(c):
        return F.timestamp_diff("SECOND", F.col(c), stamp(now)) / 3600

    hours = tables.hours.read()
    held = hours.groupBy("source").agg(F.sum("rows").alias("held"))
    sources = tables.totals.read().join(held, "source", "left").select(
        "source", (F.col("arrived") - F.coalesce("held", F.lit(0))).alias("late_rows"),
        hours_since("newest").alias("_lag"))
    lamp = F.when(F.col("_lag") >= 48, "CRIT").when(F.col("_lag") >= 24, "WARN").otherwise("OK")
    return hours.join(sources, "source").select(
        "source", "hour", "rows", "last_at", hours_since("last_at").alias("lag_hours"),
        lamp.alias("lamp"), "late_rows")
