"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks.

1. Benchmark items are cut into passages of at most ``PASSAGE`` words. Their terms are the
   vocabulary; its document frequencies are counted over the whole corpus. Every term carries
   weight, common ones little, so that a passage leaked into most documents still has its own.
2. The TF-IDF matrix of the passages is reduced by a randomised SVD: Spark multiplies the matrix and
   its transpose with a narrow random matrix, partition by partition, and only the narrow products
   meet on the driver. The right singular vectors span the latent space.
3. Every ``STRIDE`` words a region of ``REGION`` words begins. Verified are those in which the terms
   present make up ``PARAPHRASE`` of the words of a passage, common ones and repeats included. No
   common subsequence is longer than that, so nothing is left out that would be accepted.
4. The longest common subsequence of words has to cover ``VERBATIM`` of the passage, or
   ``PARAPHRASE`` of it and ``ANSWER`` of the item's answer, which is its last sentence. Documents
   with such a region are set aside while the frequencies are counted.
5. It is a leak if the window in the middle of the region and the passage have a cosine of
   ``COSINE`` in the latent space, or else if the passage is covered as much within a stretch of
   twice its length: a few common words of a short passage lie scattered over many a region.

The benchmark is treated in blocks of ``BLOCK`` passages, so what goes to the executors has a fixed
size; the corpus is read once per block, never shuffled. Inside a task the steps 3 and 4 run over the
words of a few documents at a time as arrays, in parts of about ``AT_ONCE`` cells, so that neither
long texts nor common words make them large. Words are lower-cased, ASCII punctuation
separates them.

Defined results: null and empty texts, on either side, match nothing; nor do items without an id.
Rows with a null doc_id are judged like others. Repeated items or rows give equal results, reported
once for a pair of ids. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import stored

PASSAGE = 64
BLOCK = 20_000
RANK = 128
OVERSAMPLE = 10
WINDOW, STRIDE, AROUND = 64, 16, 24
REGION = WINDOW + 2 * AROUND
#: Words of a piece of a document, a multiple of the stride.
PIECE = 16_384
#: Documents, words and cells that are treated at once.
TOGETHER, WORDS, AT_ONCE = 64, 1 << 15, 1 << 18
COSINE = 0.35
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.5, 0.6
_TO_SPACE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


class Passage(NamedTuple):
    item_id: int
    words: list[bytes]
    answer: list[bytes]


def plain_words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def passages(items: list[tuple[int, str]]) -> list[Passage]:
    out = []
    for item_id, text in items:
        words = plain_words(text)
        sentences = [s for s in map(plain_words, re.split(r"[.!?\n]+", text)) if s]
        if not words:
            continue
        n = -(-len(words) // PASSAGE)
        size = -(-len(words) // n)
        out += [Passage(item_id, words[at:at + size], sentences[-1])
                for at in range(0, len(words), size)]
    return out


def _places(words: list[bytes]) -> dict[bytes, int]:
    where: dict[bytes, int] = {}
    for i, word in enumerate(words):
        where[word] = where.get(word, 0) | 1 << i
    return where


def _subsequence(size: int, places: Iterable[int | None]) -> int:
    v = mask = (1 << size) - 1
    for at in filter(None, places):
        hit = v & at
        if hit:
            v = ((v + hit) | (v - hit)) & mask
    return size - v.bit_count()


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, one bit per word of ``a``."""
    return _subsequence(len(a), map(_places(a).get, b))


def common_subsequences(size: np.ndarray, places: np.ndarray, begin: np.ndarray,
                        end: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of many pairs at once, each of ``size`` words, at most 64, and of the
    words with ``places[begin:end]``. Carries beyond the size change nothing below it."""
    order = np.argsort(begin - end, kind="stable")
    at, length, size = begin[order], (end - begin)[order], size[order]
    full = np.uint64(2 ** 64 - 1) >> (64 - size).astype(np.uint64)
    v = full.copy()
    for k, n in enumerate(np.searchsorted(-length, -np.arange(length.max(initial=0))).tolist()):
        now = v[:n]
        hit = now & places[at[:n] + k]
        v[:n] = (now + hit) | (now - hit)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = size - np.bitwise_count(v & full)
    return out


def near(passage: list[bytes], region: list[bytes]) -> int:
    """The longest common subsequence with a stretch of the region of twice the passage."""
    size = 2 * len(passage)
    places = list(map(_places(passage).get, region))
    last = max(0, len(region) - size)
    # A stretch that begins with another word holds no more than the next one.
    return max(_subsequence(len(passage), places[at:at + size])
               for at in range(last + 1) if at == last or places[at])


class Terms(NamedTuple):
    """The terms of the passages, and how often and where each passage has each of them."""

    terms: dict[bytes, int]
    first: np.ndarray           # per term, where its passages begin in ``holders``
    holders: np.ndarray
    times: np.ndarray           # like ``holders``
    places: np.ndarray          # like ``holders``, one bit per place of the term
    size: np.ndarray            # words of each passage
    least: np.ndarray           # words of each passage that a region has to hold


def terms_of(block: list[Passage]) -> Terms:
    terms = {w: i for i, w in enumerate(sorted({w for p in block for w in p.words}))}
    places = [_places(p.words) for p in block]
    rows = np.array([(p, terms[w]) for p, where in enumerate(places) for w in where],
                    dtype=np.int64).reshape(-1, 2)
    bits = np.array([x for where in places for x in where.values()], dtype=np.uint64)
    order = np.argsort(rows[:, 1], kind="stable")
    size = np.array([len(p.words) for p in block], dtype=np.int64)
    return Terms(terms, np.searchsorted(rows[order, 1], np.arange(len(terms) + 1)), rows[order, 0],
                 np.bitwise_count(bits[order]), bits[order], size, PARAPHRASE * size)


def _slices(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in ``which``, place) of all that begins at ``first`` of each."""
    length = first[which + 1] - first[which]
    begin = first[which] - np.concatenate([[0], np.cumsum(length)[:-1]])
    return (np.repeat(np.arange(len(which)), length),
            np.repeat(begin, length) + np.arange(length.sum()))


def _runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbours whose sizes add up to at most ``most``, or one that alone is larger."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield slice(at, end)
        at = end


class Pieces(NamedTuple):
    """The terms in pieces of documents, ordered by piece, term and place."""

    steps: np.ndarray           # regions of each piece
    first: np.ndarray           # where the places of a term of a piece begin
    piece: np.ndarray           # like ``first``
    term: np.ndarray            # like ``first``
    x: np.ndarray               # places, counted from the first window
    begin: np.ndarray           # like ``x``: the regions that have the term here and not before
    end: np.ndarray             # like ``x``


def _pieces(parts: list[np.ndarray], left: np.ndarray, steps: np.ndarray, n_terms: int) -> Pieces:
    """``left`` words of a piece stand before its first window."""
    numbers = np.concatenate(parts)
    length = np.array([len(p) for p in parts])
    piece = np.repeat(np.arange(len(parts)), length)
    at = np.flatnonzero(numbers >= 0)
    key, at = np.divmod(np.sort((piece[at] * n_terms + numbers[at]) * len(numbers) + at),
                        max(1, len(numbers)))
    piece = piece[at]
    x = at - (np.cumsum(length) - length + left)[piece]
    again = np.flatnonzero(key[1:] == key[:-1]) + 1
    before = np.full(len(x), -REGION - AROUND)
    before[again] = x[again - 1]
    # A term is present in regions that begin behind its place before and up to its own.
    end = np.minimum(steps[piece], (x + AROUND) // STRIDE + 1)
    begin = np.minimum(end, np.maximum(
        0, -(-(np.maximum(before, x - REGION) + 1 + AROUND) // STRIDE)))
    new = np.delete(np.arange(len(x)), again)
    return Pieces(steps, np.append(new, len(x)), piece[new], key[new] % n_terms, x, begin, end)


def _shares(found: Pieces, known: Terms) -> Iterator[tuple[np.ndarray, ...]]:
    """(piece, passage, region, share) arrays where a region holds enough of a passage in order."""
    n = len(known.size)
    bounds = np.searchsorted(found.piece, np.arange(len(found.steps) + 1))
    work = np.bincount(found.piece, known.first[found.term + 1] - known.first[found.term],
                       minlength=len(found.steps))
    for some in _runs(work, AT_ONCE):
        low, high = bounds[some.start], bounds[some.stop]
        row, place = _slices(known.first, found.term[low:high])
        row += low
        # Passages of which the terms of the whole piece make up enough words.
        pair = (found.piece[row] - some.start) * n + known.holders[place]
        fits = (np.bincount(pair, known.times[place], minlength=(some.stop - some.start) * n)
                .reshape(-1, n) >= known.least).ravel()
        fitting = np.flatnonzero(fits)
        if not len(fitting):
            continue
        keep = np.flatnonzero(fits[pair])
        pair = (np.cumsum(fits) - 1)[pair[keep]]
        order = np.argsort(pair, kind="stable")
        pair, row, place = pair[order], row[keep][order], place[keep][order]
        piece, passage = fitting // n + some.start, fitting % n
        cells = found.steps[piece] + 1
        begins = np.searchsorted(pair, np.arange(len(fitting) + 1))
        for part in _runs(cells + np.bincount(pair, found.first[row + 1] - found.first[row]), AT_ONCE):
            which = slice(begins[part.start], begins[part.stop])
            hits = _regions(found, known, pair[which] - part.start, row[which], place[which],
                            passage[part], cells[part])
            if hits is not None:
                mine, region, share = hits
                order = np.lexsort((passage[part][mine], region, piece[part][mine]))
                mine = mine[order]
                yield piece[part][mine], passage[part][mine], region[order], share[order]


def _regions(found: Pieces, known: Terms, pair: np.ndarray, row: np.ndarray, place: np.ndarray,
             passage: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """(pair, region, share) of pairs of a piece and a passage; ``row`` and ``place`` are the terms
    that both have."""
    number, at = _slices(found.first, row)
    pair, times = pair[number], known.times[place[number]]
    offset = np.cumsum(cells) - cells
    change = (np.bincount(offset[pair] + found.begin[at], times, minlength=cells.sum())
              - np.bincount(offset[pair] + found.end[at], times, minlength=cells.sum()))
    cell = np.flatnonzero(np.cumsum(change) >= np.repeat(known.least[passage], cells))
    if not len(cell):
        return None
    mine = np.searchsorted(offset, cell, side="right") - 1
    region = cell - offset[mine]
    # The words that such a pair shares, by place: the regions are stretches of them.
    some = np.zeros(len(cells), dtype=bool)
    some[mine] = True
    shared = np.flatnonzero(some[pair])
    wide = int(found.x.max()) + 2 * REGION
    code = pair[shared] * wide + found.x[at[shared]] + AROUND
    order = np.argsort(code, kind="stable")
    code, begin = code[order], mine * wide + region * STRIDE
    size = known.size[passage[mine]]
    share = common_subsequences(size, known.places[place[number[shared[order]]]],
                                np.searchsorted(code, begin),
                                np.searchsorted(code, begin + REGION)) / size
    enough = np.flatnonzero(share >= PARAPHRASE)
    return mine[enough], region[enough], share[enough]


def numbers_of(words: list[bytes], known: Terms) -> np.ndarray:
    """The number of each word, -1 if it is no term."""
    return np.fromiter(map(known.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def shared_in_order(docs: list[np.ndarray], known: Terms) -> Iterator[tuple[int, int, int, float]]:
    """(document, passage, start of a window, share) of regions that hold enough in order."""
    pieces = [(d, at) for d, numbers in enumerate(docs) for at in range(0, len(numbers), PIECE)]
    for run in _runs(np.array([min(PIECE, len(docs[d]) - at) for d, at in pieces]), WORDS):
        some = pieces[run]
        left = np.array([min(at, AROUND) for _, at in some])
        steps = np.array([-(-min(PIECE, len(docs[d]) - at) // STRIDE) for d, at in some])
        parts = [docs[d][at - x:at + PIECE + WINDOW + AROUND] for (d, at), x in zip(some, left)]
        for found in _shares(_pieces(parts, left, steps, len(known.terms)), known):
            for piece, passage, region, share in zip(*(a.tolist() for a in found)):
                yield some[piece][0], passage, some[piece][1] + region * STRIDE, share


def _answered(passage: Passage, words: list[bytes], begin: int) -> bool:
    wide = words[max(0, begin - WINDOW):begin + 2 * WINDOW]
    return common_subsequence(passage.answer, wide) >= ANSWER * len(passage.answer)


def _together(texts: Iterable[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of a few texts at a time."""
    some: list[list[bytes]] = []
    total = 0
    for text in texts:
        some.append(plain_words(text or ""))
        total += len(some[-1])
        if len(some) == TOGETHER or total >= WORDS:
            yield some
            some, total = [], 0
    if some:
        yield some


class Index(NamedTuple):
    """What a task needs to search: the terms, their latent rows, the passages in it."""

    known: Terms
    weights: np.ndarray
    latent: np.ndarray          # terms x rank
    vectors: np.ndarray         # passages x rank, of length one
    passages: list[Passage]


def _documents(numbers: list[np.ndarray], n_terms: int) -> np.ndarray:
    """How many of the documents have each term."""
    code = np.unique(np.concatenate([k * (n_terms + 1) + 1 + x for k, x in enumerate(numbers)]))
    return np.bincount(code % (n_terms + 1), minlength=n_terms + 1)[1:]


def _leaking(docs: list[list[bytes]], numbers: list[np.ndarray], known: Terms,
             block: list[Passage]) -> set[int]:
    """The documents with a region where the rule of subsequences holds."""
    out: set[int] = set()
    for k, p, begin, share in shared_in_order(numbers, known):
        if k not in out and (share >= VERBATIM or _answered(block[p], docs[k], begin)):
            out.add(k)
    return out


def first_pass(docs: DataFrame, block: list[Passage], known: Terms, texts: bool) -> DataFrame:
    """(term, n) rows with document counts (``n`` of all documents under -1), and, if ``texts``,
    (doc_id, text) rows of the documents with an accepted region. One pass over the whole corpus."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(len(known.terms), dtype=np.int64)
        total = 0
        for pdf in batches:
            keep: list[int] = []
            before = 0
            for some in _together(pdf["text"]):
                numbers = [numbers_of(words, known) for words in some]
                seen += _documents(numbers, len(seen))
                if texts:
                    keep += [before + k for k in sorted(_leaking(some, numbers, known, block))]
                before += len(some)
            total += len(pdf)
            if texts:
                rows = pdf.iloc[keep]
                yield pd.DataFrame({"term": None, "n": None, "doc_id": rows["doc_id"],
                                    "text": rows["text"]})
        term = np.flatnonzero(seen)
        yield pd.DataFrame({"term": [-1, *term], "n": [total, *seen[term]], "doc_id": None,
                            "text": None})

    return (docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("string"), "text")
            .mapInPandas(run, "term long, n long, doc_id string, text string"))


def _tf_idf(words: list[bytes], terms: dict[bytes, int], weights: np.ndarray):
    counts = Counter(words)
    at = np.array([terms[w] for w in counts], dtype=np.int64)
    value = np.array(list(counts.values()), dtype=np.float64) * weights[at]
    norm = np.linalg.norm(value)
    return at, value / norm if norm else value


def latent_space(parts: DataFrame, terms: dict[bytes, int], weights: np.ndarray,
                 rank: int) -> np.ndarray:
    """terms x rank: right singular vectors of the TF-IDF matrix of ``parts`` (column ``words``).

    Randomised range finder with two power iterations. A task returns the product of its rows only.
    """
    def product(block: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(block)
            for pdf in batches:
                for words in pdf["words"]:
                    at, value = _tf_idf(list(words), terms, weights)
                    total[at] += np.outer(value, value @ block[at])
            term = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pd.DataFrame({"term": term, "row": list(total[term])})
        summed = (parts.mapInPandas(run, "term long, row array<double>")
                  .select("term", F.posexplode("row").alias("k", "x"))
                  .groupBy("term", "k").agg(F.sum("x").alias("x")))
        out = np.zeros_like(block)
        cells = summed.toArrow()
        out[cells["term"].to_numpy(), cells["k"].to_numpy()] = cells["x"].to_numpy()
        return out

    width = min(len(terms), rank + OVERSAMPLE)
    basis = np.random.default_rng(5).normal(size=(len(terms), width))
    for _ in range(2):
        basis = np.linalg.qr(product(basis))[0]
    # The small matrix Q' (A'A) Q has the singular values squared.
    values, rotation = np.linalg.eigh(basis.T @ product(basis))
    return basis @ rotation[:, np.argsort(-values)[:rank]]


def build_index(docs: DataFrame, block: list[Passage], texts: bool = False
                ) -> tuple[Index, DataFrame]:
    """The index of a block, and with ``texts`` the (doc_id, text) of documents worth a search."""
    known = terms_of(block)
    terms = known.terms
    passed = stored(first_pass(docs, block, known, texts), "first-pass")
    frequency, n_docs = np.zeros(len(terms), dtype=np.int64), 0
    # At most one row per term of the block.
    for row in passed.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if row["term"] < 0:
            n_docs = row["n"]
        else:
            frequency[row["term"]] = row["n"]
    # At least 1, for a term of every document.
    weights = np.log((1.0 + n_docs) / (1.0 + frequency)) + 1.0
    rows = docs.sparkSession.createDataFrame([([bytes(w) for w in p.words],) for p in block],
                                             "words array<binary>")
    latent = latent_space(rows, terms, weights, RANK)
    vectors = np.zeros((len(block), latent.shape[1]))
    for i, p in enumerate(block):
        at, value = _tf_idf(p.words, terms, weights)
        vectors[i] = value @ latent[at]
    vectors /= np.maximum(1e-12, np.linalg.norm(vectors, axis=1, keepdims=True))
    index = Index(known, weights, latent, vectors, block)
    return index, passed.filter("text IS NOT NULL").select("doc_id", "text")


def leaks(texts: Iterable[str | None], index: Index
          ) -> Iterator[list[tuple[int, float, float, bool]]]:
    """Of each whole text, (item, cosine, share of the passage, answer found) of its leaks."""
    known = index.known
    for docs in _together(texts):
        numbers = [numbers_of(words, known) for words in docs]
        best: list[dict[int, tuple[int, float, float, bool]]] = [{} for _ in docs]
        for k, p, begin, share in shared_in_order(numbers, known):
            words, passage = docs[k], index.passages[p]
            answer = _answered(passage, words, begin)
            if share < VERBATIM and not answer:
                continue
            inside = numbers[k][begin:begin + WINDOW]
            inside = inside[inside >= 0]
            window = index.weights[inside] @ index.latent[inside]
            cosine = window @ index.vectors[p] / max(1e-12, np.linalg.norm(window))
            if cosine < COSINE:
                region = words[max(0, begin - AROUND):begin + WINDOW + AROUND]
                share = near(passage.words, region) / len(passage.words)
                if share < PARAPHRASE or share < VERBATIM and not answer:
                    continue
            have = best[k].get(passage.item_id)
            if have is None or share > have[2]:
                best[k][passage.item_id] = (passage.item_id, float(cosine), share, answer)
        yield from (sorted(found.values()) for found in best)


def _blocks(benchmark: DataFrame) -> Iterator[list[Passage]]:
    """The benchmark, a stated query set, in blocks of bounded size."""
    items = (benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL")
             .select(F.col("item_id").cast("long"), "text").distinct().sort("item_id", "text"))
    block: list[Passage] = []
    for row in items.toLocalIterator():
        block += passages([(row["item_id"], row["text"])])
        if len(block) >= BLOCK:
            yield block
            block = []
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, share, answer) of every pair of a document and a leaked item."""
    id_type = docs.schema["doc_id"].dataType
    shape = "doc_id string, item_id long, cosine double, share double, answer boolean"
    found = docs.sparkSession.createDataFrame([], shape)
    for block in _blocks(benchmark):
        index, texts = build_index(docs, block, texts=True)

        def run(batches: Iterator[pd.DataFrame], index: Index = index) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = [(i, *leak) for i, found in zip(pdf["doc_id"], leaks(pdf["text"], index))
                        for leak in found]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "cosine", "share", "answer"])

        found = found.unionByName(texts.mapInPandas(run, shape))
    # An item may be spread over several blocks, and rows may repeat: one row per pair.
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("cosine").alias("cosine"), F.max("share").alias("share"),
                 F.max("answer").alias("answer"))
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a leak; all columns, no shuffle."""
    kept = docs
    for block in _blocks(benchmark):
        index, _ = build_index(docs, block)
        kept = kept.filter(~_leaked(index)("text"))
    return kept


def _leaked(index: Index):
    @F.pandas_udf("boolean")
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([bool(found) for found in leaks(text, index)], dtype=bool)
    return run
