"""Collocations of two to five words, per language, from sorted streams of exact counts.

Counting. Texts are lower-cased (A-Z), split into pieces and words, and counted in tasks: first
words, then pairs, then three to five words. Each pass emits only phrases whose parts can be frequent;
what the pass before found frequent is sent along as a bitmap of fixed size (``BITS`` bits of a
CRC-32), which may let a phrase through that is not frequent and never holds one back. Counts are
added up in Spark by phrase, so the table of frequent phrases is exact, whatever the bitmap does.

Streams. The frequent phrases of all lengths are laid out twice, in the order of their words (prefix
order) and in the order of their words from the end (suffix order), each written once in ranges of
that order. All parts of a frequent phrase are frequent, so in prefix order the first k words of a
phrase are the last entry of length k at or before it: one pass that carries the latest count of each
length meets the left count of every cut, and the count of the phrase that a word was added to. The
same pass over the suffix order gives right counts and additions on the left. What is carried into a
range are at most four counts per range before. Then both streams are merge-joined phrase by phrase;
no stream is looked up through a hash table of phrases.

Scores are whole numbers: ``floor(1000 * a * n / (l * r))`` in decimals of 38 digits.

Defined results: a null text is empty, a null language is ``und``. Rows that repeat count each time.
Texts are read whole. Ties go to the smaller cut, then to more occurrences, then to byte order. An
empty table has no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm.common import stored
from vintora.operators.skew import in_ranges

LEAST = 100             # occurrences of a frequent phrase
LONGEST = 5             # words
TOP = 2000              # phrases reported per language
BITS = 26               # log2 of the bits of a bitmap: 8 MB
CHUNK = 6_000_000       # bytes of text whose phrases a task holds at a time
WORDS_HELD = 300_000    # distinct words a task holds before it hands over its counts

# What ends a piece. The full stop stands for all of them.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_STOP = b"."
_PLAIN = bytes.maketrans(_ENDS + b"\t", _STOP * len(_ENDS) + b" ")


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of all texts in order, with a full stop wherever a piece ends."""
    joined = b".".join(texts).lower().translate(_PLAIN)
    return joined.replace(_STOP, b" . ").split()


def has_bit(bitmap: np.ndarray, lang: bytes, phrases: list[bytes]) -> np.ndarray:
    start = zlib.crc32(lang + b"\t")
    h = np.fromiter((zlib.crc32(p, start) for p in phrases), dtype=np.int64, count=len(phrases))
    h &= (1 << BITS) - 1
    return (bitmap[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1


def phrase_counts(lang: bytes, texts: list[bytes], bitmaps: list[np.ndarray]
                  ) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Phrases and their counts in these texts: pairs whose words may be frequent if one bitmap is
    given, three to five words whose pairs may be frequent if two are."""
    flat = tokens(texts)
    place: dict[bytes, int] = {_STOP: 0}
    codes = np.fromiter((place.setdefault(w, len(place)) for w in flat), dtype=np.int64, count=len(flat))
    # Numbers in byte order: phrases then leave in the order of their words, which packs well.
    names = sorted(place)
    turn = np.empty(len(names), dtype=np.int64)
    turn[[place[w] for w in names]] = np.arange(len(names))
    codes = turn[codes]
    may = has_bit(bitmaps[0], lang, names)
    may[turn[0]] = False
    alive = may[codes]
    at = np.flatnonzero(alive[:-1] & alive[1:])
    if not len(at):
        return
    _, first, number, counts = np.unique(
        codes[at] * len(names) + codes[at + 1], return_index=True, return_inverse=True, return_counts=True)
    pairs = [b" ".join(flat[i:i + 2]) for i in at[first].tolist()]
    if len(bitmaps) == 1:
        yield pairs, counts
        return
    kept = has_bit(bitmaps[1], lang, pairs)[number]
    # The number of the frequent pair that begins at a place, or -1.
    pair = np.full(len(flat), -1, dtype=np.int64)
    pair[at[kept]] = number[kept]
    here = np.flatnonzero(pair >= 0)
    group = pair
    for size in range(3, LONGEST + 1):
        here = here[here + size - 2 < len(flat)]
        here = here[pair[here + size - 2] >= 0]
        if not len(here):
            return
        _, first, number, counts = np.unique(
            group[here] * len(pairs) + pair[here + size - 2],
            return_index=True, return_inverse=True, return_counts=True)
        yield [b" ".join(flat[i:i + size]) for i in here[first].tolist()], counts
        group = np.full(len(flat), -1, dtype=np.int64)
        group[here] = number


def _batch(lang: bytes, phrases: list[bytes], counts) -> pa.RecordBatch:
    start = lang + b"\t"
    return pa.RecordBatch.from_arrays(
        [pa.array([start + p for p in phrases], pa.binary()).cast(pa.string()),
         pa.array(counts, pa.int64())], names=["entry", "f"])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    langs = batch.column(0).cast(pa.binary()).to_pylist()
    for i, lang in enumerate(langs):
        text = batch.column(1)[i].as_buffer()
        if text is not None:
            yield lang, text.to_pybytes()


def _word_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, Counter] = {}
    for batch in batches:
        for lang, text in _rows(batch):
            held.setdefault(lang, Counter()).update(tokens([text]))
            if sum(map(len, held.values())) > WORDS_HELD:
                yield from _hand_over(held)
    yield from _hand_over(held)


def _hand_over(held: dict[bytes, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, words in held.items():
        words.pop(_STOP, None)
        yield _batch(lang, list(words), list(words.values()))
    held.clear()


def _phrase_task(bitmaps: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in _rows(batch):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size > CHUNK:
                    yield from counted(held)
                    size = 0
        yield from counted(held)

    def counted(held: dict[bytes, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            for phrases, counts in phrase_counts(lang, texts, bitmaps):
                yield _batch(lang, phrases, counts)
        held.clear()
    return run


# An entry is the language, a tab and the phrase, in which there is no tab.
_COUNTED = "entry string, f bigint"


def _added(parts: DataFrame) -> DataFrame:
    phrase = F.substring_index("entry", "\t", -1)
    return parts.groupBy("entry").agg(F.sum("f").alias("f")).select(
        F.left("entry", F.length("entry") - F.length(phrase) - 1).alias("lang"),
        phrase.alias("phrase"), "f")


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """The bits of all frequent phrases: 8 MB on the driver, whatever their number."""
    at = F.crc32(F.concat_ws("\t", "lang", "phrase").cast("binary")).bitwiseAND(F.lit((1 << BITS) - 1))
    # Buckets of 32,768 bits, both counted from one.
    parts = frequent.select((at + 1).alias("at")).groupBy(
        F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros((1 << BITS) // 8, dtype=np.uint8)
    for row in parts.collect():
        out[(row["bucket"] - 1) * 4096:row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, words, f) of all phrases of one to five words with ``least`` occurrences, (lang, n))."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = stored(_added(texts.mapInArrow(_word_task, _COUNTED)), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    streams = [stored(words.filter(F.col("f") >= least), "frequent-words")]
    bitmaps: list[np.ndarray] = []
    for name in ("pairs", "phrases"):
        bitmaps = [*bitmaps, _bitmap(streams[-1])]
        counted = _added(texts.mapInArrow(_phrase_task(bitmaps), _COUNTED))
        streams.append(stored(counted.filter(F.col("f") >= least), name))
    every = streams[0].unionByName(streams[1]).unionByName(streams[2])
    return every.select("lang", F.split("phrase", " ", -1).alias("words"), "f"), totals


def stream(counts: DataFrame, key: Column) -> DataFrame:
    """The counts in the order of ``key``, the words or the reversed words, each with ``parts``: the
    count of its first k words by ``key`` at place k, for all k below its length."""
    # ``key`` is unique per language, so its order is total; a prefix precedes its extensions and
    # nothing but its extensions stands between them.
    placed = in_ranges(counts.withColumns({"key": key, "size": F.size("words")}), ["lang", "key"])
    lengths = range(1, LONGEST)
    inside = Window.partitionBy("_range").orderBy("lang", "key").rowsBetween(
        Window.unboundedPreceding, 0)
    latest = {f"in{k}": F.last(F.when(F.col("size") == k, F.col("f")), ignorenulls=True).over(inside)
              for k in lengths}
    ends = placed.groupBy("_range").agg(*[
        F.max_by(F.when(F.col("size") == k, F.col("f")),
                 F.when(F.col("size") == k, F.struct("lang", "key"))).alias(f"end{k}") for k in lengths])
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_range", *[
        F.last(f"end{k}", ignorenulls=True).over(before).alias(f"carried{k}") for k in lengths])
    return placed.withColumns(latest).join(F.broadcast(carried), "_range").select(
        "_range", "lang", "words", "size", "f",
        F.slice(F.array(*[F.coalesce(f"in{k}", f"carried{k}") for k in lengths]),
                F.lit(1), F.col("size") - 1).alias("parts"))


def _absorbed(side: DataFrame, start: int) -> DataFrame:
    """Phrases that one more word extends without losing an occurrence."""
    return side.filter((F.col("size") > 1) & (F.element_at("parts", -1) == F.col("f"))).select(
        "lang", F.slice("words", F.lit(start), F.col("size") - 1).alias("words"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    return scored(*frequent_phrases(docs, least), top)


def scored(counts: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    left = stored(stream(counts, F.col("words")), "prefix-order")
    right = stored(stream(counts, F.reverse("words")), "suffix-order")
    absorbed = _absorbed(left, 1).unionByName(_absorbed(right, 2)).distinct()
    both = left.filter("size > 1").withColumnRenamed("parts", "heads").join(
        right.select("lang", "words", F.col("parts").alias("tails")).hint("merge"), ["lang", "words"])
    free = both.join(absorbed.hint("merge"), ["lang", "words"], "left_anti")
    # One row per language.
    sums = free.join(totals, "lang")
    whole = "cast({} as decimal(19, 0))"
    cuts = F.expr(
        "array_min(transform(sequence(1, size - 1), k -> struct("
        f"(1000 * {whole.format('f')} * {whole.format('n')}) div"
        f" ({whole.format('heads[k - 1]')} * {whole.format('tails[size - k - 1]')}) as score,"
        " k as k, heads[k - 1] as l, tails[size - k - 1] as r)))")
    rows = sums.withColumn("cut", cuts).select(
        "_range", "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"),
        F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    # The first of each range, then of 256 ranges, then of all: no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for group in (F.col("_range"), (F.col("_range") / 256).cast("int"), F.lit(0)):
        ranks = Window.partitionBy("lang", group).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                         "score")
