"""Sharding by best-fit decreasing: indivisible groups into the tightest bin that still holds them.

Documents with equal texts form a group and stay together. Spark adds up the groups with partial sums
and counts them by size; that histogram is all the driver sees. Different sizes add up to the total
at most, so it has at most the square root of twice the total number of bytes rows.

Groups of one size are placed in runs: the tightest bin that holds one stays the tightest until it holds
no more, so a run fills it and goes on with the next. The result is that of placing group by group, the
smallest ones included. Spark then numbers the groups of each size and joins the runs by size and
number.

For a given number of shards, the capacity is the smallest one for which the packing fits (found by
bisection). A group above the mean of what is left takes a shard alone; no capacity could
level it, and the others are levelled among themselves.

Defined results: a null text has no bytes and is equal to the empty text; every document has one
byte more than its text, so empty ones count too. Repeated rows are documents of one group. A group
is never split, so a group larger than the capacity gets a bin of its own. Other columns are
ignored, except that the id column is returned as it is.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import numbered, stored

Counts = list[tuple[int, int]]
#: (size, number of the first group, groups, bin)
Runs = list[tuple[int, int, int, int]]


def best_fit_decreasing(counts: Counts, capacity: int) -> tuple[int, Runs]:
    """(bins, runs) for (size, how many), largest first. Bins wait in a sorted list of (room left, bin);
    ties go to the older bin. A group above the capacity opens a bin that takes nothing else."""
    runs: Runs = []
    room: list[tuple[int, int]] = []
    n_bins = 0
    for size, count in counts:
        number = 0
        while number < count:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                left, chosen = room.pop(at)
            else:
                left, chosen = capacity, n_bins
                n_bins += 1
            here = max(1, min(count - number, left // size))
            runs.append((size, number, here, chosen))
            number += here
            if left > here * size:
                insort(room, (left - here * size, chosen))
    return n_bins, runs


def level(counts: Counts, bins: int) -> Runs:
    """Bins 0 .. bins - 1 with the smallest capacity for which best-fit decreasing needs no more."""
    left, total = bins, sum(s * n for s, n in counts)
    alone: Runs = []
    rest = [list(c) for c in counts]
    taken = dict.fromkeys((s for s, _ in counts), 0)
    # Groups above the mean of the rest stand alone.
    while left > 1 and rest and rest[0][0] * left >= total:
        size = rest[0][0]
        alone.append((size, taken[size], 1, bins - left))
        taken[size] += 1
        total -= size
        left -= 1
        rest[0][1] -= 1
        if not rest[0][1]:
            rest.pop(0)
    values = [(s, n) for s, n in rest]
    if not values:
        return alone
    low = max(values[0][0], -(-total // left))
    high = 2 * low
    needed, best = best_fit_decreasing(values, high)
    while needed > left:
        high *= 2
        needed, best = best_fit_decreasing(values, high)
    # Bisection down to a thousandth of the mean bin.
    while high - low > max(1, total // (left * 1000)):
        middle = (low + high) // 2
        needed, tried = best_fit_decreasing(values, middle)
        if needed <= left:
            best, high = tried, middle
        else:
            low = middle
    return alone + [(size, first + taken[size], n, chosen + bins - left) for size, first, n, chosen in best]


def packed_groups(items: DataFrame, size: str, group: str, *, shards: int | None = None,
                  capacity: int | None = None) -> DataFrame:
    """``items`` with its ``shard``: ``shards`` level ones, or as few of ``capacity`` as it can.

    ``group`` must not be null and ``size`` positive.
    """
    groups = items.groupBy(F.col(group).alias("_g")).agg(F.sum(size).alias("_size"))
    placed = stored(numbered(groups, ["_size"], "_number", "groups"), "numbered-groups")
    # One row per size of a group.
    counts = sorted(((r["_size"], r["n"]) for r in placed.groupBy("_size").agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    runs = level(counts, shards) if shards else best_fit_decreasing(counts, capacity)[1]
    table = items.sparkSession.createDataFrame(runs, "_of long, _first long, _n long, shard int")
    number = F.col("_number")
    where = placed.join(table, (F.col("_size") == F.col("_of")) & (number >= F.col("_first"))
                        & (number < F.col("_first") + F.col("_n"))).select("_g", "shard")
    return items.join(where, items[group] == F.col("_g")).drop("_g")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of all documents.

    ``law`` is ``bytes``: the shards are level in bytes, as far as groups allow.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    items = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"),
                        F.sha2(text.cast("binary"), 256).alias("group"))
    placed = packed_groups(stored(items, "sizes"), "size", "group", shards=shards)
    slots = numbered(placed.drop("group"), ["shard"], "slot", "shards")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        "slot", F.lit(None).cast("int").alias("grown_shard"))
