"""Best-fit packing of tokenised documents into sequences of fixed length, by linear grouping.

Lengths are whole numbers up to the sequence length, so the corpus is described by one count per
length: that histogram is all the driver sees, at any size. Over it the plan is made:

1. Large lengths, longest first, are cut into groups of equal cardinality and rounded up to the
   longest of their group, which leaves few different sizes.
2. Configurations of these sizes are chosen greedily: the fullest one that holds the largest size
   left, used as often as the counts allow.
3. The actual documents take the places of their group, in rank order; what rounding left over
   becomes room.
4. Small lengths, longest first, go to the tightest room that holds them.

This is done for several numbers of groups and the plan with the fewest sequences is kept. Equal
sequences are handled as one run with a count, so a plan has a size that depends on the lengths and
not on the corpus. Spark then numbers the documents of each length and turns (length, number) into
(sequence, offset) by arithmetic.

Defined results: a null or empty text is the closing id 0 alone. Repeated rows are packed one by
one. Rows with a null id are packed too. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import kept_in_worker, numbered
from vintora.llm.tokens import Ids, tokenizer

LENGTH = 2048
GROUPS = (8, 16, 32, 64, 128)


class Run(NamedTuple):
    """Documents number .. number + count - 1 of one length: ``per`` in each sequence from
    ``sequence`` on, the first of each at ``offset``."""

    length: int
    number: int
    count: int
    sequence: int
    per: int
    offset: int


def linear_groups(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int, int]]]:
    """(length, first number, count) of each of the groups of equal cardinality, longest first."""
    total = sum(n for _, n in large)
    groups = max(1, min(groups, total))
    ends = [total * (i + 1) // groups for i in range(groups)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    at, group = 0, 0
    for length, n in large:
        number = 0
        while number < n:
            take = min(n - number, ends[group] - at)
            if take:
                out[group].append((length, number, take))
                number, at = number + take, at + take
            if at == ends[group] and group < groups - 1:
                group += 1
    return [g for g in out if g]


def fullest(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """How many of each size: the fullest configuration that holds the largest size left."""
    first = next(i for i, n in enumerate(left) if n)
    used = [0] * len(sizes)
    used[first] = 1
    room = capacity - sizes[first]
    # bit s of reach[i]: sum s can be made of the sizes before i.
    reach, steps, now = [], [], 1
    mask = (1 << (room + 1)) - 1
    for i in range(first, len(sizes)):
        free, size, power = left[i] - used[i], sizes[i], 1
        free = min(free, room // size)
        while free > 0:
            take = min(power, free)
            reach.append(now)
            steps.append((i, take))
            now |= (now << (take * size)) & mask
            free, power = free - take, power * 2
    target = now.bit_length() - 1
    for before, (i, take) in zip(reversed(reach), reversed(steps)):
        if not (before >> target) & 1:
            used[i] += take
            target -= take * sizes[i]
    return used


def make_plan(counts: dict[int, int], capacity: int, groups: int) -> tuple[int, list[Run]]:
    """(sequences, runs) for ``counts`` documents of each length from 1 to ``capacity``."""
    runs: list[Run] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    keys: list[int] = []
    sequences = 0

    def wait(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in rooms:
                rooms[room] = []
                insort(keys, room)
            rooms[room].append((first, n))

    large = sorted(((l, n) for l, n in counts.items() if l > capacity // 8 and n), reverse=True)
    if large:
        members = linear_groups(large, groups)
        sizes = [g[0][0] for g in members]
        left = [sum(n for *_, n in g) for g in members]
        queue = [list(reversed(g)) for g in members]
        while any(left):
            used = fullest(sizes, left, capacity)
            times = min(n // u for n, u in zip(left, used) if u)
            slots = [i for i, u in enumerate(used) for _ in range(u)]
            left = [n - u * times for n, u in zip(left, used)]
            columns = [_take(queue[i], times) for i in slots]
            edges = sorted({0, times, *(a for c in columns for a, *_ in c)})
            at = [0] * len(columns)
            for a, b in zip(edges, edges[1:]):
                offset = 0
                for s, column in enumerate(columns):
                    while at[s] + 1 < len(column) and column[at[s] + 1][0] <= a:
                        at[s] += 1
                    start, length, number = column[at[s]]
                    runs.append(Run(length, number + a - start, b - a, sequences + a, 1, offset))
                    offset += length
                wait(capacity - offset, sequences + a, b - a)
            sequences += times
    for length, n in sorted(((l, n) for l, n in counts.items() if l <= capacity // 8 and n),
                            reverse=True):
        number = 0
        while n:
            at_key = bisect_left(keys, length)
            if at_key == len(keys):
                opened = -(-n // (capacity // length))
                wait(capacity, sequences, opened)
                sequences += opened
                continue
            room = keys[at_key]
            first, free = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], keys[at_key]
            per = room // length
            full = min(free, n // per)
            if full:
                runs.append(Run(length, number, full * per, first, per, capacity - room))
                wait(room - per * length, first, full)
                number, n, first, free = number + full * per, n - full * per, first + full, free - full
            if n and n < per and free:
                runs.append(Run(length, number, n, first, n, capacity - room))
                wait(room - n * length, first, 1)
                first, free, n = first + 1, free - 1, 0
            wait(room, first, free)
    return sequences, runs


def _take(queue: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
    """The next ``n`` members as (index, length, number) where a stretch of one length starts."""
    out, index = [], 0
    while index < n:
        length, number, have = queue.pop()
        some = min(have, n - index)
        out.append((index, length, number))
        if some < have:
            queue.append((length, number + some, have - some))
        index += some
    return out


def best_plan(counts: dict[int, int], capacity: int) -> tuple[int, list[Run]]:
    plans = [make_plan(counts, capacity, g) for g in (*GROUPS, capacity)]
    return min(plans, key=lambda p: (p[0], len(p[1])))


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH,
           keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): whole texts, cut only above ``length``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Ids(kept_in_worker(f"tokenizer {tokenizer_path}", lambda: tokenizer(tokenizer_path)))
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()):
                ids = known.text(text or "") + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part),
                                 *((part,) if keep_ids else ())))
            known.trim()
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32",
                                              *(("ids",) if keep_ids else ())])
            if id_type in ("bigint", "int"):
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
             + ", ids binary" * keep_ids)


def pack(parts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``parts`` (with a ``length`` from 1 to the sequence length) with sequence_id and offset."""
    table = numbered(parts, ["length"], "_number", "pieces")
    counts = {int(r["length"]): int(r["n"])
              for r in table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(best_plan(counts, length)[1])
    plan = np.array(runs, dtype=np.int64).reshape(len(runs), 6)
    # Both parts fit: lengths are below 2^13 here, numbers below 2^50.
    begins = (plan[:, 0] << 50) + plan[:, 1]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size, number = pdf["length"].to_numpy(np.int64), pdf.pop("_number").to_numpy(np.int64)
            run = plan[np.searchsorted(begins, (size << 50) + number, side="right") - 1]
            turn = number - run[:, 1]
            yield pdf.assign(sequence_id=run[:, 3] + turn // run[:, 4],
                             offset=run[:, 5] + turn % run[:, 4] * size)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return table.mapInPandas(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of every document, with its place in the packed sequences."""
    return pack(pieces(docs, tokenizer_path, length), length)
