"""Quality classifier by co-training two views of a document.

One classifier sees the content (hashed words and the shape of the text), the other the metadata
(source, language, stated length). Both start from the labelled documents. In each round both score
every document without a label, and each hands the ``GIVEN`` it is surest of to the *other* one to
learn from. Labelled documents that were held out calibrate each view (Platt) and weigh the two; the
weighted logits score every whole document.

The views of all documents are described once and stored; a round reads those, and so does the last
scoring. The pool is the whole corpus at every size: Spark finds the surest by an ordered limit, and
equal documents are one candidate, so that a large group of copies cannot fill a round. What training
holds is bounded: ``LABELLED`` labelled documents, the first by the order of a hash of the id, and
``GIVEN`` pseudo-labels per view and round; features only.

Defined results: a null text counts as empty, a null source, language or length has a value of its
own. Conflicting labels of one document count by their mean, null labels not at all. Without both
labels in the sample every score is the share of good labels, 0.5 without any. Rows with a null id
are scored; repeated rows get equal scores. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintora.llm.common import stored

LABELLED = 6000
ROUNDS = 4
GIVEN = 600         # pseudo-labels per view and round, in the proportion of the known labels
SURE = 0.9
WORD_SLOTS = 512
META_SLOTS = 64
_MARKS = b"|%$&*#!<>{}[]=_@~^\\"


def content(text: str | None) -> np.ndarray:
    """Features of a whole text: shape, then hashed words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    counts = Counter(words)
    n, size = max(1, len(words)), max(1, len(data))
    lines = data.split(b"\n")
    upper = sum(1 for w in counts.elements() if w.isupper()) if n < 50 else \
        sum(c for w, c in counts.items() if w.isupper())
    shape = [np.log1p(len(words)), np.log1p(len(data)), len(counts) / n,
             max(counts.values(), default=0) / n, upper / n,
             sum(c for w, c in counts.items() if w[-1:].isalnum() or w[-1:] in b".,") / n,
             (len(data) - len(data.translate(None, _MARKS))) / size,
             (len(data) - len(data.translate(None, b"0123456789"))) / size,
             (len(data) - len(data.translate(None, b".,;:?"))) / size,
             sum(map(len, words)) / n, len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)),
             counts.get(b"|", 0) / n]
    slots = np.zeros(WORD_SLOTS)
    for word, c in counts.items():
        slots[zlib.crc32(word.lower()) % WORD_SLOTS] += c
    slots = np.sqrt(slots / n)
    return np.concatenate([shape, slots]).astype(np.float32)


def metadata(source: str | None, lang: str | None, n_chars: float | None) -> np.ndarray:
    out = np.zeros(2 * META_SLOTS + 3, dtype=np.float32)
    for k, value in enumerate((source, lang)):
        out[k * META_SLOTS + zlib.crc32(repr(value).encode()) % META_SLOTS] = 1
    known = n_chars is not None and n_chars == n_chars
    out[-3:] = (1, np.log1p(max(0.0, float(n_chars))), 0) if known else (0, 0, 1)
    return out


class View(NamedTuple):
    """Standardised logistic regression, then Platt's slope and offset."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) * self.scale) @ self.weights + self.bias
        return self.slope * raw.clip(-30, 30) + self.offset


class Model(NamedTuple):
    text: View | None
    meta: View | None
    mix: np.ndarray     # weights of the two logits, then a bias
    prior: float

    def score(self, x: np.ndarray, m: np.ndarray) -> np.ndarray:
        if self.text is None or self.meta is None:
            return np.full(len(x), self.prior)
        return _sigmoid(self.mix[0] * self.text.logit(x) + self.mix[1] * self.meta.logit(m)
                        + self.mix[2])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 12) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression by Newton steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = _sigmoid(x1 @ w)
        curve = np.maximum(p * (1 - p), 1e-4)
        hessian = (x1 * curve[:, None]).T @ x1 + np.diag(ridge)
        w -= np.linalg.solve(hessian, x1.T @ (p - y) + ridge * w)
    return w[:-1], float(w[-1])


def learn_view(x: np.ndarray, y: np.ndarray) -> View:
    mean, spread = x.mean(axis=0), x.std(axis=0)
    # A feature that never varied says nothing about rows in which it does.
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0.0)
    weights, bias = logistic((x - mean) * scale, y, penalty=5.0)
    return View(mean, scale, weights, bias)


class CoTraining:
    """The known rows of both views, to which rounds add; a quarter of ``y`` only calibrates."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray):
        self.views, self.y = views, y
        self.prior = float(y.mean()) if len(y) else 0.5
        self.hold = np.arange(len(y)) % 4 == 3
        self.possible = len(np.unique(y[~self.hold])) == 2 and len(np.unique(y[self.hold])) == 2
        if self.possible:
            self.known = [(v[~self.hold].astype(np.float64), y[~self.hold]) for v in views]
            self.models = [learn_view(*k) for k in self.known]

    def quota(self, label: int) -> int:
        return max(1, int(GIVEN * (self.prior if label else 1 - self.prior)))

    def add(self, view: int, rows: np.ndarray, labels: np.ndarray) -> None:
        """Rows of one view, labelled by the other."""
        if len(labels):
            x, y = self.known[view]
            self.known[view] = (np.concatenate([x, rows]), np.concatenate([y, labels]))

    def learn(self) -> None:
        self.models = [learn_view(*k) for k in self.known]

    def model(self) -> Model:
        if not self.possible:
            return Model(None, None, np.zeros(3), self.prior)
        hold, y = self.hold, self.y[self.hold]
        calibrated = []
        for k in (0, 1):
            raw = self.models[k].logit(self.views[k][hold].astype(np.float64))
            slope, offset = logistic(raw[:, None], y, penalty=0.1)
            calibrated.append(self.models[k]._replace(slope=max(0.0, float(slope[0])), offset=offset))
        logits = np.column_stack([m.logit(v[hold].astype(np.float64))
                                  for m, v in zip(calibrated, self.views)])
        mix, bias = logistic(logits, y, penalty=0.1)
        # A view never counts against its own verdict.
        return Model(*calibrated, np.array([*np.maximum(0, mix), bias]), self.prior)


# A described row is the shape of the text and the metadata in 4 bytes, the word slots in 2.
_SHAPE = 13


def _packed(text: str | None, source: str | None, lang: str | None, n: float | None) -> bytes:
    x, m = content(text), metadata(source, lang, n)
    places = np.concatenate([np.flatnonzero(m[:2 * META_SLOTS]), m[-3:]]).astype("<f4")
    return x[:_SHAPE].astype("<f4").tobytes() + places.tobytes() + x[_SHAPE:].astype("<f2").tobytes()


def unpacked(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(content, metadata) of described rows, one row each."""
    if not rows:
        return np.zeros((0, _SHAPE + WORD_SLOTS)), np.zeros((0, 2 * META_SLOTS + 3))
    cut = 4 * (_SHAPE + 5)
    head = np.stack([np.frombuffer(r[:cut], "<f4") for r in rows]).astype(np.float64)
    slots = np.stack([np.frombuffer(r[cut:], "<f2") for r in rows]).astype(np.float64)
    meta = np.zeros((len(rows), 2 * META_SLOTS + 3))
    for k in (0, 1):
        meta[np.arange(len(rows)), head[:, _SHAPE + k].astype(np.int64)] = 1
    meta[:, -3:] = head[:, _SHAPE + 2:]
    return np.concatenate([head[:, :_SHAPE], slots], axis=1), meta


def describe(docs: DataFrame) -> DataFrame:
    """(row, doc_id, v, h) of every document: its number, both views, and a hash of them. Stored."""
    @F.pandas_udf("binary")
    def run(text: pd.Series, source: pd.Series, lang: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_packed(*r) for r in zip(text, source, lang, n)], dtype=object)

    views = docs.select("doc_id", run("text", F.col("source").cast("string"), F.col("lang").cast("string"),
                                      F.col("n_chars").cast("double")).alias("v"))
    return stored(views.select(F.monotonically_increasing_id().alias("row"), "doc_id", "v",
                               F.xxhash64("v").alias("h")), "views")


def surest(described: DataFrame, models: list[View], taken: set[int],
           graded: DataFrame | None = None) -> DataFrame:
    """(h, row, p0, p1): each distinct description neither taken nor of a ``graded`` row, with the
    chance of a good document by either view. Views are scored in place; only chances are shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            views = unpacked(pdf["v"].tolist())
            yield pd.DataFrame({"h": pdf["h"], "row": pdf["row"], **{
                f"p{k}": _sigmoid(models[k].logit(views[k])) for k in (0, 1)}})

    scored = described.select("h", "row", "v").mapInPandas(run, "h long, row long, p0 double, p1 double")
    # At most 2 * GIVEN hashes per round.
    free = scored.filter(~F.col("h").isin(sorted(taken))) if taken else scored
    if graded is not None:
        free = free.join(graded.select("row"), "row", "left_anti")
    return free.groupBy("h").agg(F.min("row").alias("row"), F.max("p0").alias("p0"), F.max("p1").alias("p1"))


def learn(described: DataFrame, labels: DataFrame) -> Model:
    graded = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg((F.avg("quality") >= 0.5).cast("int").alias("good")))
    narrow = described.select("row", "doc_id")
    marked = stored(narrow.join(graded, "doc_id"), "graded")
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = marked.select("doc_id", "good").distinct().orderBy(*order).limit(LABELLED)
    # An id that repeats counts once, with the description of the smallest hash.
    rows = (described.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good")
            .agg(F.min_by("v", "h").alias("v")).collect())
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    state = CoTraining(unpacked([r["v"] for r in rows]), np.array([r["good"] for r in rows], dtype=np.float64))
    if not state.possible:
        return state.model()
    taken: set[int] = set()
    for _ in range(ROUNDS):
        scored = stored(surest(described, state.models, taken, marked), "round")
        picks = []
        for view in (0, 1):
            for label in (1, 0):
                sure = F.col(f"p{view}") if label else 1 - F.col(f"p{view}")
                best = scored.withColumn("sure", sure).filter(F.col("sure") >= SURE).orderBy(
                    F.desc("sure"), "h").limit(state.quota(label))
                picks += [(r["row"], r["h"], view, label) for r in best.select("row", "h").collect()]
        if not picks:
            break
        # At most 2 * GIVEN rows, apart from roundings.
        numbers = described.sparkSession.createDataFrame(sorted({(p[0],) for p in picks}), "row long")
        found = {r["row"]: r["v"] for r in described.join(F.broadcast(numbers), "row").select(
            "row", "v").collect()}
        for view in (0, 1):
            mine = [p for p in picks if p[2] == view]
            other = unpacked([found[p[0]] for p in mine])[1 - view]
            state.add(1 - view, other, np.array([p[3] for p in mine], dtype=np.float64))
        taken |= {p[1] for p in picks}
        state.learn()
    return state.model()


def score(described: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, keep) of every document; a score of 0.5 or more is kept."""
    @F.pandas_udf("double")
    def run(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=float)
        return pd.Series(np.concatenate([model.score(*unpacked(v.iloc[at:at + 1000].tolist()))
                                         for at in range(0, len(v), 1000)]))
    scored = described.select("doc_id", run("v").alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).alias("keep"))
