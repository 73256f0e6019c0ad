"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

The network reads a text's UTF-8 bytes forwards and backwards, through words and the spaces between
them, and gives every position a probability for each language; a document's probabilities are the
mean over all its positions. Whatever is no letter says little about language: ASCII digits, marks and
white space become one space. Texts are read whole, in stretches of ``STRETCH`` bytes, in which the
state runs from one end to the other; the last stretch of a text reaches back into the one before and
counts only its new positions.

Training is backpropagation through time on ``DOCS_PER_LANGUAGE`` labelled documents of each language,
chosen by a hash of the id. Their whole texts are cut into stretches in Spark, and of those the ``DRAWS``
of each language with the smallest hashes are learned from, so that every place of the texts has the
same chance. Only text and label are used, never id or source.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is everything
if nothing could be learned. Rows without an id are scored but not learned from. Rows with a null
label are scored. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOCS_PER_LANGUAGE = 400
PARTS = 64              # of each language, in which rows are chosen first
DRAWS = 20_000
STRETCH = 64
HIDDEN = 12
STEPS = 400
BATCH = 96
ROWS = 2048             # stretches that are read side by side
CHUNK = 1_000_000       # bytes whose stretches are held at a time
_TO_SPACE = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


class Net(NamedTuple):
    """``x`` bytes -> gates, ``u`` state -> gates, ``b`` bias, forwards and backwards; ``o`` output."""

    languages: list[str]
    x: np.ndarray   # 2 x 256 x 3H
    u: np.ndarray   # 2 x H x 3H
    b: np.ndarray   # 2 x 3H
    o: np.ndarray   # 2H x K
    c: np.ndarray   # K


def letters(text: str) -> bytes:
    """The bytes that are read: lower case, one space between words."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split())


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(rows x ``STRETCH`` bytes, first and end of the positions that count, per row)."""
    full, rest = divmod(len(data), STRETCH)
    out = np.full((full + (rest > 0), STRETCH), 0x20, dtype=np.uint8)
    counts = np.zeros((len(out), 2), dtype=np.int64)
    counts[:, 1] = STRETCH
    out[:full] = np.frombuffer(data, np.uint8, full * STRETCH).reshape(full, STRETCH)
    if rest and full:
        out[full] = np.frombuffer(data[-STRETCH:], np.uint8)
        counts[full, 0] = STRETCH - rest
    elif rest:
        out[0, :rest] = np.frombuffer(data, np.uint8)
        counts[0, 1] = rest
    return out, counts


def has_letter(text: str | None) -> bool:
    return text is not None and (re.search("[A-Za-z]", text) is not None
                                 or any(c.isalpha() for c in text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _steps(net: Net, way: int, codes: np.ndarray, live: np.ndarray | None, keep: list | None):
    """States after each position of ``codes`` (time x rows); ``live`` masks padding."""
    hidden = net.u.shape[1]
    h = np.zeros((codes.shape[1], hidden), dtype=np.float32)
    out = np.empty((len(codes), codes.shape[1], hidden), dtype=np.float32)
    for t in range(len(codes)) if way == 0 else range(len(codes) - 1, -1, -1):
        a = net.x[way][codes[t]] + net.b[way]
        g = h @ net.u[way]
        zr = _sigmoid(a[:, :2 * hidden] + g[:, :2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        n = np.tanh(a[:, 2 * hidden:] + r * g[:, 2 * hidden:])
        new = n + z * (h - n)
        if live is not None:
            new = np.where(live[t][:, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, n, g[:, 2 * hidden:]))
        out[t] = h = new
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def probabilities(net: Net, codes: np.ndarray) -> np.ndarray:
    """time x rows x languages, for whole stretches: the steps above without masks, gate by gate in
    arrays of their own and in place."""
    hidden = net.u.shape[1]
    n_rows = codes.shape[1]
    out = None
    for way in (0, 1):
        gates = [slice(k * hidden, (k + 1) * hidden) for k in range(3)]
        # A sigmoid is half a tanh of half the input.
        half = (0.5, 0.5, 1.0)
        inputs = [np.ascontiguousarray((net.x[way] + net.b[way])[:, g] * f, np.float32) for g, f in zip(gates, half)]
        turns = [np.ascontiguousarray(net.u[way][:, g] * f, np.float32) for g, f in zip(gates, half)]
        states = np.empty((len(codes), n_rows, hidden), dtype=np.float32)
        z, r, n = (np.empty((n_rows, hidden), dtype=np.float32) for _ in range(3))
        h = np.zeros((n_rows, hidden), dtype=np.float32)
        for t in range(len(codes)) if way == 0 else range(len(codes) - 1, -1, -1):
            for gate, table, turn in ((z, inputs[0], turns[0]), (r, inputs[1], turns[1])):
                np.dot(h, turn, out=gate)
                gate += table.take(codes[t], axis=0)
                np.tanh(gate, out=gate)
                gate *= 0.5
                gate += 0.5
            np.dot(h, turns[2], out=n)
            n *= r
            n += inputs[2].take(codes[t], axis=0)
            np.tanh(n, out=n)
            new = states[t]
            np.subtract(h, n, out=new)
            new *= z
            new += n
            h = new
        part = states @ net.o[way * hidden:(way + 1) * hidden]
        out = part if out is None else out + part
    out += net.c
    out -= out.max(axis=-1, keepdims=True)
    np.exp(out, out=out)
    out /= out.sum(axis=-1, keepdims=True)
    return out


def _gradients(net: Net, codes: np.ndarray, live: np.ndarray, labels: np.ndarray):
    kept: tuple[list, list] = ([], [])
    states = np.concatenate([_steps(net, way, codes, live, kept[way]) for way in (0, 1)], axis=2)
    delta = _softmax(states @ net.o + net.c)
    delta[:, np.arange(len(labels)), labels] -= 1
    delta *= (live / live.sum())[:, :, None]
    hidden = net.u.shape[1]
    grad = [np.zeros_like(p) for p in net[1:]]
    grad[3] = np.einsum("tnh,tnk->hk", states, delta)
    grad[4] = delta.sum(axis=(0, 1))
    back = (delta @ net.o.T).astype(np.float32)
    for way in (0, 1):
        dh = np.zeros((codes.shape[1], hidden), dtype=np.float32)
        for t, h, z, r, n, g in reversed(kept[way]):
            dh = dh + back[t][:, way * hidden:(way + 1) * hidden]
            d = np.where(live[t][:, None], dh, 0)
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(grad[0][way], codes[t], da)
            grad[1][way] += h.T @ dg
            grad[2][way] += da.sum(axis=0)
            dh = np.where(live[t][:, None], d * z + dg @ net.u[way].T, dh)
    return grad


def train(parts: dict[str, list[bytes]], seed: int = 9) -> Net:
    """Fit the network to stretches by language, all languages weighing the same."""
    rng = np.random.default_rng(seed)
    languages = sorted(k for k, v in parts.items() if v)
    parts = {k: sorted(parts[k]) for k in languages}
    k = len(languages)
    scale = 1 / np.sqrt(HIDDEN)
    net = Net(languages, *(rng.normal(0, s, shape).astype(np.float32) for s, shape in (
        (0.3, (2, 256, 3 * HIDDEN)), (scale, (2, HIDDEN, 3 * HIDDEN)), (0.0, (2, 3 * HIDDEN)),
        (scale, (2 * HIDDEN, max(1, k))), (0.0, (max(1, k),)))))
    if k < 2:
        return net
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net[1:]]
    for step in range(1, STEPS + 1):
        labels = rng.integers(0, k, BATCH)
        rows = [parts[languages[y]][int(rng.integers(0, len(parts[languages[y]])))] for y in labels]
        # Every fourth row is cut short, as short texts are.
        rows[::4] = [row[:int(rng.integers(1, len(row) + 1))] for row in rows[::4]]
        size = max(map(len, rows))
        codes = np.zeros((size, BATCH), dtype=np.int64)
        live = np.zeros((size, BATCH), dtype=bool)
        for i, row in enumerate(rows):
            codes[:len(row), i] = np.frombuffer(row, np.uint8)
            live[:len(row), i] = True
        rate = 0.02 * (1 - 0.9 * step / STEPS)
        for p, g, (m, v) in zip(net[1:], _gradients(net, codes, live, labels), moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(p.dtype)
    return net


def position_sums(net: Net, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """rows x languages: the probabilities of the positions that count, added up."""
    out = np.zeros((len(rows), len(net.languages)))
    place = np.arange(STRETCH)[:, None]
    # Short texts end before their row does, and so do the network's states.
    short = counts[:, 1] < STRETCH
    for masked, some in ((False, np.flatnonzero(~short)), (True, np.flatnonzero(short))):
        for at in range(0, len(some), ROWS):
            here = some[at:at + ROWS]
            codes = np.ascontiguousarray(rows[here].T)
            live = (place >= counts[here, 0]) & (place < counts[here, 1])
            if masked:
                states = np.concatenate([_steps(net, way, codes, live, None) for way in (0, 1)], axis=2)
                p = _softmax(states @ net.o + net.c)
            else:
                p = probabilities(net, codes)
            odd = np.flatnonzero(~live.all(axis=0))
            p[:, odd] *= live[:, odd, None]
            out[here] = p.sum(axis=0, dtype=np.float64)
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> DataFrame:
    """(lang, part): the stretches to learn from, at most ``DRAWS`` of each language."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                        & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = first_by(known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct(),
                      ["h", "doc_id"], DOCS_PER_LANGUAGE)
    # At most DOCS_PER_LANGUAGE rows of two columns for each language.
    texts = known.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                data = letters(text)
                yield pd.DataFrame({"lang": lang, "part": [
                    data[at:at + STRETCH] for at in range(0, len(data), STRETCH)]})

    parts = texts.select("lang", "text").mapInPandas(run, "lang string, part binary")
    return first_by(parts.withColumn("h", F.xxhash64("part")), ["h", "part"], DRAWS).select("lang", "part")


def first_by(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each language: in parts first, then among what is left of them."""
    for part in (F.pmod("h", F.lit(PARTS)), F.lit(0)):
        within = Window.partitionBy("lang", part).orderBy(*order)
        rows = rows.withColumn("n", F.row_number().over(within)).filter(F.col("n") <= n)
    return rows


def learn(docs: DataFrame) -> Net:
    parts: dict[str, list[bytes]] = {}
    for row in sample(docs).toLocalIterator():
        parts.setdefault(row["lang"], []).append(bytes(row["part"]))
    return train(parts)


class Scorer:
    """(language, score) of whole texts."""

    def __init__(self, net: Net):
        self.net = net

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out, held, size = [], [], 0
        for text in texts:
            known = self.net.languages and has_letter(text)
            held.append(letters(text) if known else b"")
            size += len(held[-1])
            if size > CHUNK:
                out += self._chunk(held)
                held, size = [], 0
        return out + self._chunk(held)

    def _chunk(self, texts: list[bytes]) -> list[tuple[str, float]]:
        cut = [stretches(t) for t in texts]
        if not sum(len(rows) for rows, _ in cut):
            return [("und", 0.0)] * len(texts)
        sums = position_sums(self.net, np.concatenate([r for r, _ in cut]),
                             np.concatenate([c for _, c in cut]))
        ends = np.cumsum([len(rows) for rows, _ in cut])
        out = []
        for text, first, end in zip(texts, [0, *ends], ends):
            if not text:
                out.append(("und", 0.0))
                continue
            # Equal texts get equal scores, whatever they are read beside.
            pooled = (sums[first:end].sum(axis=0) / len(text)).round(5)
            out.append((self.net.languages[int(pooled.argmax())], float(min(1.0, pooled.max()))))
        return out


def predict(docs: DataFrame, net: Net) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; ``doc_id`` is text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(net)
        for pdf in batches:
            found = scorer(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": [f[0] for f in found],
                                "score": [f[1] for f in found]})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id string, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    # Without nulls in an integer column pandas keeps it whole; with them the id passes as text.
    ids = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    kind = docs.schema["doc_id"].dataType
    out = predict(ids, learn(docs))
    return out.select(F.col("doc_id").cast(kind).alias("doc_id"),
                      held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, least: float) -> DataFrame:
    """The rows whose text is in a learned language with at least this score; all columns, no
    shuffle. If no language could be learned, only texts without a letter go.

    Rows pass through the task in Arrow batches, so none waits beside it for its verdict.
    """
    net = learn(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            fits = ([score >= least for _, score in scorer(texts)] if net.languages
                    else [has_letter(t) for t in texts])
            yield batch.filter(pa.array(fits, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
