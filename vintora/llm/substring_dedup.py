"""Repeated passages: hashed pieces of lines, of which only the earliest ranked occurrence stays.

A unit is a line, or a part of one: inside a line a unit ends before each word whose hash is lower
than those of its neighbours up to ``REACH`` words away. So the cuts depend on the words around
them only, and a passage pasted into the middle of another line falls into the same units again,
but for one at either end. Units are normalised (A-Z lower-cased, white space between words taken
as one space) and digested to 64 bits.

Digests are grouped over the whole corpus with the smallest (doc_id, position) as the rank, by
partial sums, so frequent lines meet no single task; only repeated digests are joined back. A later
occurrence is removed where it is part of a run of neighbouring repeated units with at least
``MIN_WORDS`` words; shorter coincidences of parts of lines stay. With ``whole_lines`` a line that
repeats an earlier whole line goes at any number of words: lines under ``MIN_WORDS`` words have a
digest of their own for that, longer ones are runs already.

Defined results: null and empty texts have no units and stay as they are. A row without an id has
no rank; it stays whole and removes nothing elsewhere. Rows repeated exactly rank as one and are
cut alike. Two different texts under one id rank by position. Other columns pass unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import mixed, word_hashes

REACH = 3
MIN_WORDS = 20
_STEP = 0x9E3779B97F4A7C15
# Sets the digests of whole lines apart from those of units.
_LINE = 0x5851F42D4C957F2D
_UNITS = "doc_id long, crc long, unit int, digest long, first int, last int, n_words int"


class Powers:
    """Powers of the step and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(4096, 2 * n)
            for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 2 ** 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


def units(text: str, powers: Powers,
          line_words: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(digest, first character, character after the last, words) of each unit of a whole text, and
    behind them of each line under ``line_words`` words; the words of lines count as negative."""
    data = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    n = len(starts)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    h = word_hashes(data.lower().split())
    line = np.cumsum(codes == 10)[starts]
    cut = np.zeros(n, dtype=bool)
    cut[0] = True
    cut[1:] = line[1:] != line[:-1]
    spread = mixed(h)
    low = np.ones(n, dtype=bool)
    for k in range(1, min(REACH, n - 1) + 1):
        same = line[k:] == line[:-k]
        # Equal neighbours make no cut, so a repeated word does not shred its line.
        low[k:] &= ~same | (spread[k:] < spread[:-k])
        low[:-k] &= ~same | (spread[:-k] < spread[k:])
    at = np.flatnonzero(cut | low)
    till = np.append(at[1:], n)
    n_units = len(at)
    if line_words:
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], n)
        short = end - begin < line_words
        at, till = np.append(at, begin[short]), np.append(till, end[short])
    powers.need(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers.up[:n], dtype=np.uint64)])
    size = (till - at).astype(np.uint64)
    salt = np.where(np.arange(len(at)) < n_units, 0, _LINE).astype(np.uint64)
    digest = mixed((sums[till] - sums[at]) * powers.down[at] + size + salt)
    first, last = starts[at], ends[till - 1]
    if not text.isascii():
        # From bytes to characters: count the bytes that begin one.
        begun = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
        first, last = begun[first], begun[last]
    return (digest.view(np.int64), first, last,
            np.where(np.arange(len(at)) < n_units, till - at, at - till))


def _table(docs: DataFrame, line_words: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for pdf in batches:
            parts = [units(t, powers, line_words) for t in pdf["text"]]
            counts = [len(p[0]) for p in parts]
            crcs = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in pdf["text"]]
            columns = [np.concatenate(c) if parts else np.zeros(0) for c in zip(*parts)] \
                if parts else [np.zeros(0, np.int64)] * 4
            yield pd.DataFrame({
                "doc_id": np.repeat(pdf["doc_id"].to_numpy(), counts), "crc": np.repeat(crcs, counts),
                "unit": np.concatenate([np.arange(c) for c in counts]) if counts else [],
                "digest": columns[0], "first": columns[1], "last": columns[2],
                "n_words": columns[3]})
    text = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    return text.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, _UNITS)


def repeated(docs: DataFrame, line_words: int = 0) -> DataFrame:
    """(doc_id, crc, units): the later occurrences of repeated units of each text, and of its
    repeated lines under ``line_words`` words."""
    table = _table(docs, line_words)
    earliest = (table.groupBy("digest").agg(
        F.min(F.struct("doc_id", "first")).alias("rank"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("digest", F.col("rank.doc_id").alias("rank_id"),
                                F.col("rank.first").alias("rank_first")))
    later = table.join(earliest, "digest").filter("doc_id != rank_id OR first != rank_first")
    # A group is one document: as long as its text at most.
    return later.groupBy("doc_id", "crc").agg(
        F.collect_set(F.struct("unit", "first", "last", "n_words")).alias("units"))


def runs(found: list[tuple[int, int, int, int]], min_words: int) -> list[tuple[int, int]]:
    """Character spans of runs of neighbouring units with enough words."""
    out, total = [], 0
    at = None
    for unit, first, last, n in sorted(found):
        if at is not None and unit == at + 1:
            total, end, at = total + n, last, unit
        else:
            if total >= min_words:
                out.append((begin, end))
            begin, end, total, at = first, last, n, unit
    if total >= min_words:
        out.append((begin, end))
    return out


def removals(found: list[tuple[int, int, int, int]], min_words: int) -> list[tuple[int, int]]:
    """Character spans of runs with enough words and of whole lines, put together where they meet."""
    spans = runs([u for u in found if u[3] > 0], min_words)
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans + [(u[1], u[2]) for u in found if u[3] < 0]):
        if out and first < out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text less the spans and the white space behind each."""
    kept, at = [], 0
    for first, last in spans:
        kept.append(text[at:first])
        at = last
        while at < len(text) and text[at] in " \t\n\r\x0b\x0c":
            at += 1
    return "".join(kept) + text[at:] if spans else text


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS,
                 spans_as: str | None = "removed", whole_lines: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without later repeats: runs of ``min_words`` words
    and, with ``whole_lines``, every line that repeats an earlier one. A column ``spans_as`` (in
    place of one of that name) has the spans (first, last) taken out, in characters of the
    original text."""
    whole = docs.select(F.struct("*").alias("row"))
    keyed = whole.select("row", F.col("row.doc_id").cast("long").alias("doc_id"),
                         F.crc32(F.col("row.text").cast("binary")).alias("crc"))
    marked = keyed.join(repeated(docs, min_words if whole_lines else 0), ["doc_id", "crc"], "left")
    udf = F.pandas_udf(_cut(min_words), "text string, removed array<struct<first int, last int>>")
    done = marked.select("row", udf("row.text", "units").alias("new"))
    kept = [F.col(f"row.`{c}`") if c != "text" else F.col("new.text")
            for c in docs.columns if c != spans_as]
    return done.select(*kept, *([F.col("new.removed").alias(spans_as)] if spans_as else []))


def _cut(min_words: int):
    def run(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        spans = [removals([(u["unit"], u["first"], u["last"], u["n_words"]) for u in some], min_words)
                 if some is not None else [] for some in found]
        return pd.DataFrame({
            "text": [t if t is None else without(t, s) for t, s in zip(text, spans)],
            "removed": [[{"first": a, "last": b} for a, b in s] for s in spans]})
    run.__annotations__ = {"text": pd.Series, "found": pd.Series, "return": pd.DataFrame}
    return run
