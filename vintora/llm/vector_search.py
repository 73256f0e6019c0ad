"""Exact top-k inner-product search over a vector-approximation file.

The approximation file is a table of blocks that hold, for some rows, the ids and one byte per
component: its cell in an equal-width grid over the block. It is stored beside the exact vectors.

1. A search scans cells only. A cell bounds a component, so a row of cells bounds the score with any
   query from both sides. Per block and query the rows are kept whose upper bound reaches the k-th
   lower bound; over all blocks the same rule is applied again.
2. Exact vectors are fetched by their ids, in the order of the upper bounds: first the ``FIRST * k``
   best of each query, and then only those whose upper bound reaches the k-th exact score found.
   No other vector can be in the answer, so the rest is never read.

Blocks of queries meet blocks of cells by an equi-join on the query block; nothing is broadcast and no
task holds more than one block of each.

Defined results: vectors that are null, or hold a null or non-finite component, and rows without
an id take no part. Vectors of different lengths have no score. Where an id occurs more than once,
the smallest of its vectors asks. A score beyond a long is cut to its end. Rows with equal vectors
are reduced to their k + 1 smallest ids before the file is built: no other of them can be in an
answer, since ties go to the smaller id, so a vector that fills a third of the table costs no more
than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm.common import stored

CELLS = 256
QUERY_BLOCK = 16_384
FIRST = 4
_LONG = np.iinfo(np.int64)
_FILE = "dim int, ids binary, low binary, width binary, cells binary"
_QUERIES = "qb int, dim int, q_ids binary, q_vecs binary"


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, v): every component as floor(scale * x), rows that take no part left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (df.filter(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda e: F.floor(e.cast("double") * scale)).alias("v")))


def _file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for dim, part in pdf.groupby(pdf["v"].map(len)):
            cells, low, width = grid(_matrix(part["v"], int(dim)))
            rows.append((int(dim), part["id"].to_numpy("<i8").tobytes(), low.tobytes(),
                         width.tobytes(), cells.tobytes()))
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FILE.split(", ")])


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), dim)


def grid(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, lower end of the grid, cell width) per component."""
    low = vecs.min(axis=0).astype(np.float64)
    width = (vecs.max(axis=0) - low + 1.0) / CELLS
    return np.floor((vecs - low) / width).clip(0, CELLS - 1).astype(np.uint8), low, width


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, queries x rows."""
    block = queries.astype(np.float64)
    corner = low + cells * width
    base = block @ corner.T
    # Rounding of the sums, generously.
    slack = 1e-9 * (np.abs(block) @ (np.abs(low) + CELLS * width)) + 1e-6
    return (base + (np.minimum(block, 0) @ width - slack)[:, None],
            base + (np.maximum(block, 0) @ width + slack)[:, None])


def scan(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, cells: np.ndarray,
         low: np.ndarray, width: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """(query_id, vec_id, lower, upper) of the rows of one block that can be among the k best."""
    single = len(np.unique(ids)) == len(ids)
    for at in range(0, len(query_ids), 256):
        names = query_ids[at:at + 256]
        lower, upper = bounds(queries[at:at + 256], cells, low, width)
        own = names[:, None] == ids[None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        if single and len(ids) > k:
            floor = np.partition(lower, -k, axis=1)[:, -k]
        else:
            # An id with several vectors counts once.
            floor = np.array([_kth(row, ids, k) for row in lower])
        q, row = np.nonzero((upper >= floor[:, None]) & ~own)
        yield pd.DataFrame({"query_id": names[q], "vec_id": ids[row], "lower": lower[q, row],
                            "upper": upper[q, row]})


def _kth(lower: np.ndarray, ids: np.ndarray, k: int) -> float:
    best = pd.Series(lower).groupby(ids).max().nlargest(k)
    return float(best.iloc[-1]) if len(best) >= k else -np.inf


def _scan_task(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids, asked = (np.frombuffer(x, "<i8") for x in (row.ids, row.q_ids))
                yield from scan(
                    asked, np.frombuffer(row.q_vecs, "<i8").reshape(len(asked), row.dim), ids,
                    np.frombuffer(row.cells, np.uint8).reshape(len(ids), row.dim),
                    np.frombuffer(row.low), np.frombuffer(row.width), k)
    return run


def _exact_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for dim, part in pdf.groupby(pdf["v"].map(len)):
            q, v = _matrix(part["q"], int(dim)), _matrix(part["v"], int(dim))
            top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, dim)
            if top < 2.0 ** 62:
                scores = (q * v).sum(axis=1)
            else:
                whole = (q.astype(object) * v.astype(object)).sum(axis=1)
                scores = np.array([min(max(int(s), _LONG.min), _LONG.max) for s in whole], np.int64)
            yield pd.DataFrame({"query_id": part["query_id"], "vec_id": part["vec_id"], "score": scores})


def approximation_file(vectors: DataFrame) -> DataFrame:
    """The blocks of cells of (id, v)."""
    return vectors.mapInPandas(_file, _FILE)


def candidates(file: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, upper): by the cells alone, every row that can be among the k best."""
    n_blocks = max(1, -(-asking.count() // QUERY_BLOCK))
    blocks = (asking.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
              .withColumn("dim", F.size("v")).groupBy("qb", "dim")
              .applyInPandas(_query_block, _QUERIES))
    pairs = (file.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
             .join(blocks, ["qb", "dim"]))
    found = pairs.mapInPandas(_scan_task(k), "query_id long, vec_id long, lower double, upper double")
    each = found.groupBy("query_id", "vec_id").agg(F.max("lower").alias("lower"),
                                                   F.max("upper").alias("upper"))
    floor = (each.withColumn("n", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("lower"), "vec_id")))
        .filter(F.col("n") == k).select("query_id", F.col("lower").alias("floor")))
    return each.join(floor, "query_id", "left").filter(
        F.col("floor").isNull() | (F.col("upper") >= F.col("floor"))).select("query_id", "vec_id", "upper")


def exact(wanted: DataFrame, vectors: DataFrame, asking: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) of the wanted pairs: only their vectors are fetched."""
    pairs = (wanted.select("query_id", "vec_id")
             .join(vectors.select(F.col("id").alias("vec_id"), "v"), "vec_id")
             .join(asking.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id")
             .filter(F.size("q") == F.size("v")))
    # A repeated row is one candidate.
    return pairs.mapInPandas(_exact_task, "query_id long, vec_id long, score long").dropDuplicates()


def read_in_turn(found: DataFrame, vectors: DataFrame, asking: DataFrame, k: int
                 ) -> tuple[DataFrame, DataFrame]:
    """(scores, pairs read): the best upper bounds first, then what can still beat the k-th score."""
    turn = Window.partitionBy("query_id").orderBy(F.desc("upper"), "vec_id")
    ordered = stored(found.withColumn("turn", F.row_number().over(turn)), "candidates")
    first = ordered.filter(F.col("turn") <= FIRST * k)
    scores = stored(exact(first, vectors, asking), "scores")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (scores.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k)
           .select("query_id", F.col("score").alias("kth")))
    second = (ordered.filter(F.col("turn") > FIRST * k).join(kth, "query_id", "left")
              .filter(F.col("kth").isNull() | (F.col("upper") >= F.col("kth"))))
    read = first.select("query_id", "vec_id").unionByName(second.select("query_id", "vec_id"))
    return scores.unionByName(exact(second, vectors, asking)), read


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for tables of (id, v) as ``integer_vectors`` makes them."""
    same = Window.partitionBy("v").orderBy("id")
    # The rank limit is applied before the shuffle too, so a frequent vector is cut early.
    vectors = stored(rows.withColumn("_n", F.row_number().over(same))
                     .filter(F.col("_n") <= k + 1).select("id", "v"), "vectors")
    asking = stored(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    file = stored(approximation_file(vectors), "cells")
    scores, _ = read_in_turn(candidates(file, asking, k), vectors, asking, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _query_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    vecs = _matrix(pdf["v"], int(key[1]))
    return pd.DataFrame([(int(key[0]), int(key[1]), pdf["id"].to_numpy("<i8").tobytes(), vecs.tobytes())],
                        columns=["qb", "dim", "q_ids", "q_vecs"])
