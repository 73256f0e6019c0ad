"""Load rules: scans, file contracts, full and windowed replacement, run log."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintora.functions import has_text, not_in_or_null
from vintora.operators.relational import duplicates
from vintora.session import checkpoint_dir, freeing_shuffles


class EmptyLoad(ValueError):
    """The source answered with no rows; the previous load stays."""


class BrokenContract(ValueError):
    """A file does not have the agreed columns or keys."""


# -- scans -----------------------------------------------------------------

def project(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Only the listed source fields, under their staging names ({name: source})."""
    return df.select(*[F.col(source).alias(name) for name, source in fields.items()])


def window_or_keys(source: DataFrame, at: str, cutoff, key: str, refresh: DataFrame) -> DataFrame:
    """Rows inside the window, plus older rows whose key is on the refresh list. One pass over the
    source, which may be costly to make."""
    listed = refresh.select(F.col(key).alias("_listed")).filter("_listed IS NOT NULL").distinct()
    return (source.join(listed, F.col(key) == F.col("_listed"), "left")
            .filter((F.col(at) >= cutoff) | F.col("_listed").isNotNull()).drop("_listed"))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """One level of structs to columns; anything deeper, and arrays, to JSON text.

    Decided by the schema, not by looking at the data.
    """
    nested = (T.StructType, T.ArrayType, T.MapType)

    def leaf(c: Column, kind: T.DataType, name: str) -> Column:
        return (F.to_json(c) if isinstance(kind, nested) else c).alias(name)

    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            out += [leaf(F.col(f"`{field.name}`.`{f.name}`"), f.dataType,
                         f"{field.name}{sep}{f.name}") for f in field.dataType.fields]
        else:
            out.append(leaf(F.col(f"`{field.name}`"), field.dataType, field.name))
    return df.select(*out)


# The readers that keep the first interface; Parquet without it answers from its footers.
_FIRST_API = "spark.sql.sources.useV1SourceList"


def from_footers(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Parquet files read so that counts, minima and maxima of numbers and dates come from their
    footers alone. For plain aggregates over whole files; anything else reads the rows."""
    before = spark.conf.get(_FIRST_API)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(_FIRST_API, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.schema(schema).parquet(*paths)
    finally:
        spark.conf.set(_FIRST_API, before)


# -- files -----------------------------------------------------------------

def read_contract(spark: SparkSession, path: str, columns: dict[str, str],
                  types: dict[str, str] | None = None) -> DataFrame:
    """CSV with required columns ({source: name}); others dropped, types cast."""
    raw = spark.read.csv(path, header=True)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise BrokenContract(f"{path}: missing columns {missing}, found {raw.columns}")
    types = types or {}
    return raw.select(*[
        (F.trim(f"`{source}`") if name not in types
         else F.col(f"`{source}`").try_cast(types[name])).alias(name)
        for source, name in columns.items()])


def read_ordered(spark: SparkSession, path: str, header: list[str], names: list[str],
                 key: str, numeric: list[str]) -> DataFrame:
    """CSV whose header must match in order; columns are then taken by position.

    Two headers may differ only in case, so names alone would not tell them apart.
    """
    first = spark.read.text(path).first()
    found = [h.strip() for h in first[0].split(",")] if first else []
    if found != header:
        raise BrokenContract(f"{path}: header {found} is not {header}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True)
    # Texts that stand for no value. In a number a 0 is a 0.
    empty = ("", "0", "nan", "None")
    clean = rows.select(*[
        F.trim(n).alias(n) if n in numeric
        else F.when(~F.trim(n).isin(*empty), F.trim(n)).alias(n) for n in names])
    if key in numeric:
        unread = clean.filter(has_text(key) & F.col(key).try_cast("double").isNull()).take(3)
        if unread:
            raise BrokenContract(f"{path}: {key} is no number in {[r[key] for r in unread]}")
    repeated = duplicates(clean.filter(F.col(key).isNotNull()), [key]).take(3)
    if repeated:
        raise BrokenContract(f"{path}: repeated {key}, e.g. {[r[0] for r in repeated]}")
    return clean.withColumns({n: F.col(n).try_cast("double") for n in numeric})


def profile(df: DataFrame, key: str, numeric: list[str]) -> DataFrame:
    """Rows, distinct keys, nulls, and minimum, maximum and sum of the numbers, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns],
        *[f(n).alias(f"{n}_{label}") for n in numeric
          for label, f in (("min", F.min), ("max", F.max), ("sum", F.sum))])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


# -- replacement -----------------------------------------------------------

class VersionedTable:
    """Parquet versions below one folder. A version counts once its marker file exists, so a
    reader sees either the old or the new table, and a lost job leaves the old one.

    The marker holds the schema: opening a version reads no file footer and infers nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = spark._jvm.org.apache.hadoop.fs
        self._fs = self._files.Path(self.path).getFileSystem(
            spark._jsc.hadoopConfiguration())

    def _marker(self, version: int):
        return self._files.Path(f"{self.path}/v{version}.ok")

    def versions(self) -> list[int]:
        root = self._files.Path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n[1:-3]) for n in names if n.startswith("v") and n.endswith(".ok"))

    def exists(self) -> bool:
        return bool(self.versions())

    def schema(self, version: int) -> T.StructType:
        stream = self._fs.open(self._marker(version))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(text))

    def read(self) -> DataFrame:
        version = self.versions()[-1]
        return self.spark.read.schema(self.schema(version)).parquet(f"{self.path}/v{version}")

    def files(self) -> list[str]:
        """The folder of the current version."""
        return [f"{self.path}/v{self.versions()[-1]}"]

    def replace(self, df: DataFrame, by: str | None = None, keep: int | None = None,
                check: Callable[[DataFrame], object] | None = None) -> int:
        """Write a new version and make it current; no rows means no change.

        ``check`` sees the written version before it becomes current and may raise. With ``keep``
        only so many versions stay; give readers of older ones time to end.

        With ``by`` the version is partitioned by that column. The rebalance gives each value as
        many files as its size asks for, so neither small files nor one huge writer arise.
        """
        version = (self.versions() or [0])[-1] + 1
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = (counted.hint("rebalance", by).write.partitionBy(by) if by else counted.write)
        freeing_shuffles(df.sparkSession,
                         lambda: writer.mode("overwrite").parquet(f"{self.path}/v{version}"))
        rows = seen.get["rows"]
        if rows == 0:
            raise EmptyLoad(f"{self.path}: the load has no rows")
        if check is not None:
            check(self.spark.read.schema(df.schema).parquet(f"{self.path}/v{version}"))
        stream = self._fs.create(self._marker(version))
        stream.write(bytearray(df.schema.json().encode()))
        stream.close()
        if keep:
            for old in self.versions()[:-keep]:
                self._fs.delete(self._marker(old), False)
                self._fs.delete(self._files.Path(f"{self.path}/v{old}"), True)
        return rows


def refresh_keys(current: DataFrame, key: str, status: str, final, at: str, cutoff) -> DataFrame:
    """Keys older than the window that can still change: status unknown or not final."""
    return current.filter(not_in_or_null(status, final) & (F.col(at) < cutoff)
                          & has_text(key)).select(key).distinct()


def window_replace(current: DataFrame, incoming: DataFrame, at: str, cutoff, key: str,
                   refresh: DataFrame) -> DataFrame:
    """The table after a windowed load: old rows stay unless in the window or refreshed."""
    kept = current.filter((F.col(at) < cutoff) | F.col(at).isNull()).join(
        refresh.select(key), key, "left_anti")
    return kept.unionByName(incoming)


def load_mode(requested_full: bool, windowed: bool, last_full: dt.datetime | None,
              now: dt.datetime, full_after_days: int) -> str:
    """'full' or 'window' for the next load of a table."""
    overdue = last_full is None or now - last_full >= dt.timedelta(days=full_after_days)
    return "full" if requested_full or not windowed or overdue else "window"


def load_modes(log: DataFrame, windowed: list[str], now: dt.datetime, full_after_days: int
               ) -> DataFrame:
    """(table_name, last_full, mode): the same decision for every table of the log."""
    overdue = F.lit(now - dt.timedelta(days=full_after_days)).cast("timestamp_ntz")
    tables = log.select("table_name").distinct()
    last = tables.join(last_full_loads(log), "table_name", "left")
    full = (~F.col("table_name").isin(*windowed) | F.col("last_full").isNull()
            | (F.col("last_full") <= overdue))
    return last.withColumn("mode", F.when(full, "full").otherwise("window"))


# -- run log ---------------------------------------------------------------

def definition_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def append_new(log: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """The log with the entries it does not have yet; a second call changes nothing."""
    fresh = entries.dropDuplicates(keys).join(log.select(*keys).distinct(), keys, "left_anti")
    return log.unionByName(fresh)


def last_full_loads(log: DataFrame) -> DataFrame:
    return log.filter(F.col("mode") == "full").groupBy("table_name").agg(
        F.max("started_at").alias("last_full"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints, reachable by all executors."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vintora/{name}-{uuid.uuid4().hex}"
