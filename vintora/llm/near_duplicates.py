"""Near duplicates by SetSketch registers: banded, estimated by likelihood, verified on full sets.

A document is the set of its distinct word shingles. Its sketch has 128 registers: the minimum of
an exponential hash over the set, on a scale of powers of ``BASE`` and cut off at both ends. Such
minima merge by maximum of registers and agree for two sets about as often as the sets do.

1. Equal sets are one node, the smallest document id stands for it.
2. Four registers in a row are a band; documents that agree in one of 32 bands share a bucket. Two
   documents at the limit of 0.75 share none with a probability of (1 - 0.75^4)^32 = 5e-6.
3. Every member of a bucket is held against one leader, the member that shares most buckets with
   others. Pairs with a likely similarity far below the limit, by the joint likelihood of the two
   sketches and the known set sizes, are dropped (six standard deviations); the others are
   verified on the full sets. Links give components, and within one no further pair needs a look.
4. What is left are members of one bucket in different components; a bucket of two has none left.
   Those outside the bucket's largest component ask the rest. Buckets with the same largest component
   form one cluster, in which askers and members meet in blocks of bounded bytes with their full
   sets; only links leave a task, never pairs. That is the same for clusters of every size.

Defined results: a text that is null or has no word has no shingles, links with nothing and is
kept. A row without an id is its own document: component null, kept. Rows that repeat an id are
judged one by one under the same id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import mixed, stored, word_hashes, words
from vintora.llm.graph import components

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
# Parameters of the sketch: base of the scale, rate of the hash, highest register.
BASE, RATE, TOP = 1.001, 20.0, 2 ** 16 - 1
# Six standard deviations of 128 registers below the limit.
LIKELY = 0.5
# Documents and bytes of shingles that a block of a cluster holds on average.
BLOCK, BLOCK_BYTES = 512, 8 << 20
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(0, 2 ** 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 2 ** 32, REGISTERS, dtype=np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    h = word_hashes(words(text or ""))
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + h[k:k + n]
    return np.unique(mixed(out))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per (not empty) set."""
    x = (mixed(np.concatenate(sets) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), REGISTERS), dtype=np.uint32)
    hashed = np.empty_like(x)
    for i in range(REGISTERS):
        np.multiply(x, _FACTORS[i], out=hashed)
        np.add(hashed, _SHIFTS[i], out=hashed)
        least[:, i] = np.minimum.reduceat(hashed, starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0 ** 32) / RATE
    return np.floor(1 - np.log(exponential) / np.log(BASE)).clip(0, TOP).astype("<u2")


def likely_similarity(n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of greatest joint likelihood, given both sizes; rows are pairs.

    The counts of registers where one side is above the other follow from the share that only
    this side has; the grid below finds the best similarity to one percent.
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    best, top = np.zeros(len(a)), np.full(len(a), -np.inf)
    for j in np.linspace(0, 1, 101):
        rest = np.log(np.maximum(1e-12, np.stack([
            _shifted(u - v * j), _shifted(v - u * j)])))
        same = np.log(np.maximum(1e-12, 1 - np.exp(rest).sum(axis=0)))
        value = above * rest[0] + below * rest[1] + equal * same
        better = value > top
        best[better], top[better] = j, value[better]
    return best


def _shifted(x: np.ndarray) -> np.ndarray:
    """Probability that a register is strictly above, on the scale of powers of BASE."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, bands): the registers, four in a long."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingles(t) for t in pdf["text"]]
            bands: list[np.ndarray | None] = [None] * len(sets)
            block: list[int] = []
            for i, s in enumerate(sets):
                if len(s):
                    block.append(i)
                # Blocks that fit into the processor's cache.
                if block and (i == len(sets) - 1 or sum(len(sets[j]) for j in block) > 50_000
                              or len(block) > 500):
                    for j, row in zip(block, registers([sets[j] for j in block])):
                        bands[j] = row.view("<i8")
                    block = []
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "text_hash": pdf["text_hash"],
                "n_shingles": [len(s) for s in sets],
                "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "bands": bands})
    hashed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return hashed.mapInPandas(run, "doc_id long, text_hash long, n_shingles long, digest binary, "
                                   "bands array<long>")


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity is likely enough to be verified."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sides = [np.array(pdf[c].tolist(), dtype="<i8").view("<u2") for c in ("bands_a", "bands_b")]
            n_a, n_b = (pdf[c].to_numpy(np.float64) for c in ("n_a", "n_b"))
            yield pdf.loc[likely_similarity(n_a, n_b, *sides) >= LIKELY, ["a", "b"]]
    sides = [nodes.select(F.col("id").alias(s), F.col("n_shingles").alias(f"n_{s}"),
                          F.col("bands").alias(f"bands_{s}")) for s in "ab"]
    # Sizes alone rule some out: the smaller over the larger bounds the similarity.
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    return (pairs.join(sides[0], "a").join(sides[1], "b").filter(fits)
            .mapInPandas(run, "a long, b long"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"))
                    for x, y in zip(pdf["set_a"], pdf["set_b"])]
            yield pdf.loc[np.array(keep, dtype=bool), ["a", "b"]]
    sides = [sets.select(F.col("id").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInPandas(run, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)


def _full_sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(id, shingles) of the documents that occur in a pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"],
                                "shingles": [shingles(t).tobytes() for t in pdf["text"]]})
    text = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return text.join(needed, "id", "left_semi").mapInPandas(run, "id long, shingles binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every document."""
    rows = stored(sketches(docs), "sketches")
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    nodes = stored(known.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.max("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands")), "nodes")
    bucket = ["band", "key"]
    members = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    counts = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(members.join(counts, bucket), "buckets")
    degrees = shared.groupBy("id").agg(F.sum("n").alias("degree"))
    leaders = (shared.join(degrees, "id").groupBy(*bucket)
               .agg(F.max(F.struct("degree", F.xxhash64("id").alias("h"), "id")).alias("l"))
               .select(*bucket, F.col("l.id").alias("leader")))
    stars = (shared.join(leaders, bucket).filter("id != leader")
             .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
             .distinct())
    stars = stored(stars, "stars")
    sets = stored(_full_sets(docs, shared.select("id").distinct()), "sets")
    links = stored(_verified(_estimated(stars, nodes), sets), "links")
    found = stored(components(links), "components")
    more = stored(_across(shared, found, nodes, sets), "more")
    if not more.isEmpty():
        # Later links join whole components.
        ends = [found.select(F.col("id").alias(s), F.col("component").alias(f"c_{s}")) for s in "ab"]
        joined = components(more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
            F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")))
        top = joined.withColumnRenamed("id", "c").withColumnRenamed("component", "top")
        inside = found.join(top, found["component"] == top["c"], "left").select(
            "id", F.coalesce("top", "component").alias("component"))
        # Documents that had no link before come from the later ones.
        found = inside.unionByName(joined.join(found, "id", "left_anti").select("id", "component"))
    classes = nodes.join(found, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    return (rows.drop("bands").join(classes, "digest", "left")
            .withColumn("component_id", F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select("doc_id", "text_hash", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def _across(shared: DataFrame, found: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different components so far."""
    bucket = ["band", "key"]
    # The two of a bucket of two have met: one of them is the leader.
    placed = stored(shared.filter("n > 2").drop("n").join(found, "id", "left").withColumn(
        "part", F.coalesce("component", "id")).select(*bucket, "id", "part"), "placed")
    sizes = placed.groupBy(*bucket, "part").agg(F.count(F.lit(1)).alias("n"))
    main = (sizes.groupBy(*bucket).agg(F.max(F.struct("n", "part")).alias("m"),
                                       F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").select(*bucket, F.col("m.part").alias("main")))
    # Of each cluster its members, and who among them asks.
    within = (placed.join(main, bucket).select("main", "id", "part").distinct()
              .withColumn("asks", F.col("part") != F.col("main"))
              .join(nodes.select("id", "n_shingles"), "id"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES))
    extent = within.groupBy("main").agg(blocks.cast("int").alias("blocks"))
    clusters = stored(within.drop("n_shingles").join(extent, "main"), "clusters")
    return _in_blocks(clusters, sets)


def _in_blocks(clusters: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between askers and members of the clusters, block by block."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = (clusters.withColumn("block", block).join(sets, "id")
            .withColumn("row", F.struct("id", "part", "shingles")))
    sides = {s: df.groupBy("main", "blocks", "block").agg(F.collect_list("row").alias(s))
             for s, df in (("asking", rows.filter("asks")), ("held", rows))}
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = sides["asking"].select("main", "asking", F.explode(every).alias("block"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for asking, held in zip(pdf["asking"], pdf["held"]):
                yield pd.DataFrame(list(block_links(
                    [(r["id"], r["part"], np.frombuffer(r["shingles"], "<u8")) for r in asking],
                    [(r["id"], r["part"], np.frombuffer(r["shingles"], "<u8")) for r in held])),
                    columns=["a", "b"], dtype="int64")

    met = spread.join(sides["held"].select("main", "block", "held"), ["main", "block"])
    return met.select("asking", "held").mapInPandas(run, "a long, b long").distinct()


def block_links(asking: list[tuple], held: list[tuple]) -> Iterator[tuple[int, int]]:
    """Links between two blocks of (id, component, sorted shingles), across components."""
    ids, parts = (np.array(c, dtype=np.int64) for c in list(zip(*held))[:2])
    sizes = np.array([len(h[2]) for h in held])
    every = np.concatenate([h[2] for h in held])
    order = np.argsort(every, kind="stable")
    owner, every = np.repeat(np.arange(len(held)), sizes)[order], every[order]
    for name, part, own in asking:
        first, last = np.searchsorted(every, own), np.searchsorted(every, own, side="right")
        length = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        both = np.bincount(owner[at], minlength=len(held))
        fits = 100 * both >= PERCENT * (len(own) + sizes - both)
        for k in np.flatnonzero(fits & (parts != part)):
            yield min(int(name), int(ids[k])), max(int(name), int(ids[k]))
