"""Row by row comparison of two tables that mostly agree.

Both sides are reduced to one checksum per bucket of keys. The checksums do not depend on order and
add up in tasks, so nothing is shuffled for the buckets that agree; only rows of buckets that differ
are brought together and compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _row(columns: list[str]) -> Column:
    """A row as text: JSON tells nulls from empty texts and one column from the next."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def checksums(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, sum): at most one row per bucket. Rows count as often as they occur."""
    # Two hashes of 64 bits, summed without overflow: equal sums of different rows are out of reach.
    text = _row([*keys, *columns])
    first, second = (F.xxhash64(F.lit(n), text).cast("decimal(20,0)") for n in (1, 2))
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first).alias("first"), F.sum(second).alias("second"))


def unequal_buckets(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str],
                    buckets: int = BUCKETS) -> DataFrame:
    """(bucket) of those whose rows are not the same on both sides; at most ``buckets`` rows."""
    sides = checksums(left, keys, columns, buckets).unionByName(
        checksums(right, keys, columns, buckets).withColumns({
            c: -F.col(c) for c in ("rows", "first", "second")}))
    return sides.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "first", "second")]).filter(
        "rows <> 0 OR first <> 0 OR second <> 0").select("bucket")


def differences(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str],
                buckets: int = BUCKETS) -> DataFrame:
    """(keys, kind, changed, left_rows, right_rows): keys whose rows differ.

    ``kind`` is only_left, only_right, or changed; ``changed`` lists the columns of a key that has
    one row on either side. Keys may be null and may repeat: then all rows of a key are compared.
    """
    # Bounded by the number of buckets.
    opened = F.broadcast(unequal_buckets(left, right, keys, columns, buckets))

    def side(df: DataFrame, name: str) -> DataFrame:
        rows = (df.select(*keys, *columns).withColumn("bucket", _bucket(keys, buckets))
                .join(opened, "bucket"))
        # Equal rows are counted first: a key that repeats a row is one entry.
        counted = rows.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("n"))
        return counted.withColumn("side", F.lit(name))

    both = side(left, "l").unionByName(side(right, "r"))
    net = both.groupBy(*keys, *columns).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "l", F.col("n"))), F.lit(0)).alias("l"),
        F.coalesce(F.sum(F.when(F.col("side") == "r", F.col("n"))), F.lit(0)).alias("r"))
    per_key = net.groupBy(*keys).agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"),
        F.count_if(F.col("l") != F.col("r")).alias("odd"), *[
            # Of two rows a column differs if its least and greatest value do, or one is null.
            (~F.min(F.col(f"`{c}`")).eqNullSafe(F.max(F.col(f"`{c}`")))
             | (F.count(F.col(f"`{c}`")) == 1)).alias(f"_{i}") for i, c in enumerate(columns)])
    single = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    return per_key.filter("odd > 0").select(
        *keys, F.when(F.col("right_rows") == 0, "only_left").when(F.col("left_rows") == 0, "only_right")
        .otherwise("changed").alias("kind"),
        F.when(single, F.array_compact(F.array(*[
            F.when(F.col(f"_{i}"), c) for i, c in enumerate(columns)]))).alias("changed"),
        "left_rows", "right_rows")
