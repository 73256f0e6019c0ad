import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vintora.operators.distinct import bitmap_cells, dense_numbers, margins
from vintora.operators.relational import (
    assert_unique, dates, descending, first_per_key, interval_lookup, islands,
    match_with_fallback, months, tail_from,
)
from vintora.operators.skew import in_ranges, keyed_window, number_rows


def d(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def skewed(spark):
    """Nine of ten rows on one key, a NULL key, and ties in the order column."""
    rows = [(None if i % 30 == 0 else f"c{i % 40}" if i % 10 == 0 else "hot", i // 5, i, i % 4)
            for i in range(900)]
    return spark.createDataFrame(rows, "k STRING, at INT, id INT, v INT")


def same(left, right):
    return sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


def test_keyed_window_equals_plain_window(ranges, skewed):
    out = keyed_window(skewed, ["k"], ["-at", "id"],
                       {"n": F.lit(1), "odd": F.when(F.col("v") % 2 == 1, F.col("v"))},
                       {"top": ("max", F.col("id")), "low": ("min", F.when(F.col("v") > 1, F.col("id")))})
    w = Window.partitionBy("k").orderBy(F.col("at").desc(), "id")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("k")
    assert same(out, skewed.withColumns({
        "n": F.row_number().over(w).cast("bigint"),
        "odd": F.coalesce(F.sum(F.when(F.col("v") % 2 == 1, F.col("v"))).over(run), F.lit(0)),
        "top": F.max("id").over(whole),
        "low": F.min(F.when(F.col("v") > 1, F.col("id"))).over(whole)}))


def test_keyed_window_with_more_keys(ranges, skewed):
    out = keyed_window(skewed, ["k", "v"], ["id"], {"n": F.lit(1)})
    w = Window.partitionBy("k", "v").orderBy("id")
    assert same(out, skewed.withColumn("n", F.row_number().over(w).cast("bigint")))


@pytest.mark.parametrize("count", [4, 8, 40, 200])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranges_are_fixed_in_storage(spark, count, reuse):
    """Right at any number of ranges, with exchange reuse or without, with one key of 90 %.

    The second reader looks at two columns only: pruning must not change the ranges.
    """
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 97).otherwise(F.lit(-1)).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).alias("at"), "id", (F.col("id") % 7).alias("v"))
    spark.conf.set("spark.vintora.ranges", str(count))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        out = keyed_window(df, ["k"], ["at", "id"], {"n": F.lit(1), "s": F.col("v")},
                           {"top": ("max", F.col("v")), "all": ("sum", F.col("v"))})
        got = out.toPandas().sort_values("id").reset_index(drop=True)
        narrow = out.select("id", "n").toPandas().sort_values("id").reset_index(drop=True)
    finally:
        spark.conf.unset("spark.vintora.ranges")
        spark.conf.unset("spark.sql.exchange.reuse")
    plain = df.toPandas().sort_values(["at", "id"])
    plain["n"] = plain.groupby("k").cumcount() + 1
    plain["s"] = plain.groupby("k")["v"].cumsum()
    plain["top"] = plain.groupby("k")["v"].transform("max")
    plain["all"] = plain.groupby("k")["v"].transform("sum")
    plain = plain.sort_values("id").reset_index(drop=True)
    columns = ["id", "n", "s", "top", "all"]
    assert got[columns].equals(plain[columns])
    assert narrow.equals(plain[["id", "n"]])


def test_no_task_holds_a_whole_hot_key(spark, skewed):
    spark.conf.set("spark.vintora.ranges", "40")
    try:
        sizes = in_ranges(skewed, ["k", "at", "id"]).groupBy("_range").count().collect()
    finally:
        spark.conf.unset("spark.vintora.ranges")
    assert max(r["count"] for r in sizes) < 90


def test_number_rows(ranges, skewed):
    got = {r["id"]: r["n"] for r in number_rows(skewed, ["id"], "n").collect()}
    assert got == {i: i + 1 for i in range(900)}


def test_first_per_key_puts_null_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", d("2024-01-02"), 2), ("a", d("2024-01-05"), 3), ("b", None, 4)],
        "k STRING, at DATE, id INT")
    first = {r["k"]: r["id"] for r in first_per_key(df, ["k"], [F.col("at")]).collect()}
    last = {r["k"]: r["id"] for r in first_per_key(df, ["k"], [descending("at")]).collect()}
    assert first == {"a": 2, "b": 4} and last == {"a": 3, "b": 4}


def test_fallback_uses_the_second_key_only_when_needed(spark):
    pay = spark.createDataFrame(
        [("S1", "O9", 1), ("uuid", "O2", 2), ("uuid", "none", 3), (None, "O1", 4), ("S2", None, 5),
         ("  ", "O1", 6)], "t STRING, o STRING, id INT")
    keys = spark.createDataFrame(
        [("S1", "O1"), ("S2", "O2"), ("S3", "O2")], "so STRING, oid STRING")
    got = match_with_fallback(pay, keys, ("t", "so"), ("o", "oid")).collect()
    assert sorted((r["id"], r["matched_key"]) for r in got) == [
        (1, "S1"), (2, "S2"), (2, "S3"), (4, "S1"), (5, "S2"), (6, "S1")]


def test_interval_lookup_keeps_unmatched(spark):
    facts = spark.createDataFrame([("a", d("2024-01-05")), ("a", d("2024-03-01")),
                                   ("z", d("2024-01-01"))], "c STRING, day DATE")
    spans = spark.createDataFrame([("a", d("2024-01-01"), d("2024-01-31"), "R1")],
                                  "c STRING, f DATE, t DATE, route STRING")
    got = interval_lookup(facts, spans, "c", F.col("day"), "f", "t", ["route"])
    assert sorted((r["c"], str(r["day"]), r["route"]) for r in got.collect()) == [
        ("a", "2024-01-05", "R1"), ("a", "2024-03-01", None), ("z", "2024-01-01", None)]


def test_islands_ignore_calendar_gaps_and_nulls(spark):
    rows = [("a", d("2024-01-01"), "R1", "x"), ("a", d("2024-01-02"), None, "x"),
            ("a", d("2024-01-20"), "R1", "y"), ("a", d("2024-01-20"), "R1", "z"),
            ("a", d("2024-01-21"), "R2", "x"), ("a", d("2024-01-22"), "R1", "x")]
    df = spark.createDataFrame(rows, "c STRING, day DATE, route STRING, boss STRING")
    got = sorted((r["route"], str(r["valid_from"]), str(r["valid_to"]), r["days"], r["boss"])
                 for r in islands(df, "c", "day", "route", ["boss"]).collect())
    assert got == [("R1", "2024-01-01", "2024-01-20", 3, "z"),
                   ("R1", "2024-01-22", "2024-01-22", 1, "x"),
                   ("R2", "2024-01-21", "2024-01-21", 1, "x")]


def test_sequences(spark):
    a, b = F.lit("2024-01-31").cast("date"), F.lit("2024-03-01").cast("date")
    row = spark.range(1).select(
        F.size(months(a, b)).alias("m"), months(b, a).alias("none"), F.size(dates(a, b)).alias("d"),
        tail_from(F.array(F.lit(1), F.lit(3), F.lit(5)), F.lit(3)).alias("tail")).first()
    assert (row["m"], row["none"], row["d"], row["tail"]) == (3, None, 31, [3, 5])


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, v STRING")
    assert_unique(df, ["k", "v"], "t")
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, ["k"], "t")


def test_margins_are_exact(spark, ranges):
    """Cells, margins and the total against plain distinct counts, over several buckets of numbers."""
    df = spark.range(150_000).select(
        (F.col("id") % 70_001).alias("who"), (F.col("id") % 3).alias("a"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("b"), F.col("id") % 4)).alias("b"))
    df = df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS who, 9L AS a, 'x' AS b"))
    numbers = dense_numbers(df, "who", ["a"])
    top = numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(top) == (1, 70_001, 70_001)
    bitmaps = bitmap_cells(df.join(numbers, "who", "left"), ["a", "b"], "number").persist()
    levels = {"cell": ["a", "b"], "a": ["a"], "b": ["b"], "all": []}
    got = {(r["level"], r["a"], r["b"]): r["distinct"] for r in margins(bitmaps, ["a", "b"], levels).collect()}
    expected = {}
    for level, keys in levels.items():
        for r in df.filter("who IS NOT NULL").groupBy(*keys).agg(F.count_distinct("who").alias("n")).collect():
            expected[level, r["a"] if "a" in keys else None, r["b"] if "b" in keys else None] = r["n"]
    assert got == expected
    assert [tuple(r) for r in margins(bitmaps.limit(0), ["a", "b"], levels).collect()] == [
        ("all", None, None, 0)]
    bitmaps.unpersist()
