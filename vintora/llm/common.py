"""Helpers that several operators share: reading, stored tables, gapless numbers, words."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintora.sources.load import scratch


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys: list[str], out: str, name: str) -> DataFrame:
    """Gapless numbers from 0 within ``keys`` (no nulls in them), for keys of any size.

    Rows are numbered inside the partition they were written from, and the counts of the
    partitions before are added; a task never holds more of a key than one input split had.
    """
    table = stored(df.withColumns({"_part": F.spark_partition_id(),
                                   "_at": F.monotonically_increasing_id()}), name)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (table.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
               .select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(*keys, "_part").orderBy("_at")
    local = table.withColumn("_rn", F.row_number().over(inside).cast("long") - 1)
    return (local.join(offsets, [*keys, "_part"])
            .withColumn(out, F.col("_rn") + F.col("_off"))
            .drop("_part", "_at", "_rn", "_off"))


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """An object of fixed size that this Python worker keeps for its later tasks."""
    place = sys.modules.setdefault("_worker_caches", types.ModuleType("_worker_caches"))
    if not hasattr(place, name):
        setattr(place, name, make())
    return getattr(place, name)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[bytes]:
    """UTF-8 words between the ASCII spaces 0x20 and 0x09-0x0D, A-Z lower-cased.

    ``bytes.split`` and ``bytes.lower`` act on exactly these characters.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def batches(rows: list[tuple], size: int) -> Iterator[list[tuple]]:
    for at in range(0, len(rows), size):
        yield rows[at:at + size]
