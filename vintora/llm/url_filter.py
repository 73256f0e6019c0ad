"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from labelled URLs; by default the labels are the verdicts of the rules themselves,
so that what the rules say is carried over to URLs they do not reach. Features are lengths, depth,
digit ratio, entropy, counts of parameters and marks, and statistics of suffixes: how often URLs
with this last host label, these two last labels or this first path segment were blocked.

The statistics are a Spark table by the suffix itself, joined to the URLs; few rows tend to the
overall share, and so does a suffix nobody has labelled. A labelled URL gets the statistics of the
other folds only, and all URLs of a host are in one fold: the trees thus see each training URL as they
will see one of an unknown host, and cannot read its own label out of its suffix. The trees are fitted
on at most ``SAMPLE`` distinct labelled URLs, the first by the order of a hash.

Defined results: a URL that is null or has no ``://`` has empty host and path, fits no rule and is
judged by the trees. Without labelled URLs everything that no rule covers is allowed; with one
verdict only, that verdict holds. Repeated rows get equal results, whole URLs of any length are
read, rows with a null id are judged too. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintora.llm.common import ascii_lower, stored

SAMPLE = 20_000
FOLDS = 5
PRIOR_ROWS = 20.0
SMALL = 200_000         # rows of statistics up to which they are broadcast
TREES, DEPTH, RATE, BINS, LEAF = 40, 3, 0.2, 32, 20
SUFFIXES = ("last_label", "last_two_labels", "first_segment")
RATES = tuple(f"rate{k}" for k in range(len(SUFFIXES)))


class Rule(NamedTuple):
    """``host`` (and its subdomains) and the start of the path."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, its verdict); among rules of one length a block wins."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def suffixes(host: Column, path: Column) -> list[Column]:
    """The suffix of each kind."""
    keys = [F.substring_index(host, ".", -1), F.substring_index(host, ".", -2),
            F.get(F.split(path, "/", 3), F.lit(1))]
    return [F.coalesce(k, F.lit("")) for k in keys]


def lexical(url: str, host: str, path: str) -> list[float]:
    size = len(url)
    _, _, tail = url.partition("?")
    query = tail.partition("#")[0]
    segments = [s for s in path.split("/") if s]
    counts = np.fromiter(Counter(url).values(), dtype=np.float64)
    share = counts / size if size else counts
    marks = sum(url.count(m) for m in "-_%~+")
    return [size, len(host), len(path), len(segments), max(map(len, segments), default=0),
            sum(c.isdigit() for c in url) / max(1, size), float(-(share * np.log2(share)).sum()),
            sum(1 for p in query.split("&") if p), host.count("."), marks,
            sum(c.isupper() for c in url) / max(1, size), float("@" in host or ":" in host),
            float("." in segments[-1]) if segments else 0.0]


class Trees(NamedTuple):
    """Boosted trees of one depth: split feature and threshold per inner node, value per leaf."""

    base: float
    features: np.ndarray    # trees x (2^depth - 1)
    thresholds: np.ndarray
    leaves: np.ndarray      # trees x 2^depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss on histograms of at most ``BINS`` bins."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    empty = (np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return Trees(0.0 if not len(y) else (-9.0, 9.0)[int(y[0])], *empty)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, curve = y - p, p * (1 - p)
        features, thresholds = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for at in range(inner):
            here = node == at
            if here.sum() >= 2 * LEAF:
                best = _split(binned[here], grad[here], curve[here])
                if best is not None:
                    features[at], thresholds[at] = best[0], cuts[best[0]][best[1]]
            right = here & (x[:, features[at]] > thresholds[at])
            node[here] = 2 * at + 1
            node[right] = 2 * at + 2
        leaf = node - inner
        g = np.bincount(leaf, grad, leaves)
        h = np.bincount(leaf, curve, leaves)
        values = RATE * g / (h + 1.0)
        margin += values[leaf]
        trees.append((features, thresholds, values))
    return Trees(base, *(np.array(part) for part in zip(*trees)))


def _split(binned: np.ndarray, grad: np.ndarray, curve: np.ndarray) -> tuple[int, int] | None:
    """(feature, cut) of the best gain; rows with a bin up to the cut go left."""
    best, found = 1e-9, None
    g_all, h_all = grad.sum(), curve.sum()
    for f in range(binned.shape[1]):
        n = np.bincount(binned[:, f], minlength=2).cumsum()[:-1]
        g = np.bincount(binned[:, f], grad, 2).cumsum()[:-1]
        h = np.bincount(binned[:, f], curve, 2).cumsum()[:-1]
        gain = g ** 2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all ** 2 / (h_all + 1)
        gain[(n < LEAF) | (len(binned) - n < LEAF)] = -1
        if len(gain) and gain.max() > best:
            best, found = float(gain.max()), (f, int(gain.argmax()))
    return found


def suffix_counts(known: DataFrame) -> DataFrame:
    """(kind, suffix, fold, b, n): blocked and all labelled URLs of each suffix and fold."""
    cells = known.select("block", "fold", F.posexplode(F.array(*SUFFIXES)).alias("kind", "suffix"))
    return cells.groupBy("kind", "suffix", "fold").agg(F.sum("block").alias("b"),
                                                       F.count("block").alias("n"))


def with_rates(urls: DataFrame, counts: DataFrame, prior: float) -> DataFrame:
    """``urls`` with a rate per kind, without the counts of the row's own ``fold`` (null: of none)."""
    sums = counts.groupBy("kind", "suffix").agg(
        F.sum("b").alias("b"), F.sum("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("b", "n")))).alias("folds"))
    # A suffix has one row with a map of FOLDS entries.
    small = sums.count() <= SMALL
    for k, name in enumerate(SUFFIXES):
        side = sums.filter(F.col("kind") == k).select(
            F.col("suffix").alias(name), F.col("b").alias("_b"), F.col("n").alias("_n"),
            F.col("folds").alias("_f"))
        urls = urls.join(F.broadcast(side) if small else side, name, "left")
        own = F.when(F.col("fold").isNotNull(), F.try_element_at("_f", "fold"))
        rest = {c: F.coalesce(f"_{c}", F.lit(0)) - F.coalesce(own[c], F.lit(0)) for c in ("b", "n")}
        urls = urls.withColumn(f"rate{k}", (rest["b"] + PRIOR_ROWS * prior) / (
            rest["n"] + PRIOR_ROWS)).drop("_b", "_n", "_f")
    return urls


def _matrix(url: pd.Series, host: pd.Series, path: pd.Series, *rates: pd.Series) -> np.ndarray:
    rows = np.array([lexical(u or "", h, p) for u, h, p in zip(url, host, path)]).reshape(len(url), -1)
    return np.column_stack([rows, *(r.to_numpy(np.float64) for r in rates)])


def _parsed(df: DataFrame, *more: Column) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    df = df.select(*more, "url", host.alias("host"), path.alias("path"))
    return df.withColumns(dict(zip(SUFFIXES, suffixes(F.col("host"), F.col("path")))))


class Filter(NamedTuple):
    """What was learned: the statistics and the trees."""

    counts: DataFrame
    prior: float
    trees: Trees

    def score(self, urls: DataFrame) -> DataFrame:
        """``urls`` as ``_parsed`` makes them, with ``block_score``."""
        trees = self.trees

        @F.pandas_udf(T.DoubleType())
        def run(url: pd.Series, host: pd.Series, path: pd.Series, a: pd.Series, b: pd.Series,
                c: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-trees.margin(_matrix(url, host, path, a, b, c)))))

        rated = with_rates(urls.withColumn("fold", F.lit(None).cast("int")), self.counts, self.prior)
        return rated.withColumn("block_score", run("url", "host", "path", *RATES))


def learn(labelled: DataFrame) -> Filter:
    """From (url, block); rows without a label count for nothing."""
    known = stored(_parsed(labelled, F.col("block").cast("int").alias("block")).filter(
        "block IS NOT NULL").withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")),
        "labelled-urls")
    counts = stored(suffix_counts(known), "suffixes")
    total = known.agg(F.sum("block").alias("b"), F.count("block").alias("n")).first()
    prior = total["b"] / total["n"] if total["n"] else 0.5
    distinct = known.dropDuplicates(["url"]).orderBy(F.xxhash64("url"), "url").limit(SAMPLE)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def described(url: pd.Series, host: pd.Series, path: pd.Series, a: pd.Series, b: pd.Series,
                  c: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(url, host, path, a, b, c)))

    rows = with_rates(distinct, counts, prior).select(
        "block", described("url", "host", "path", *RATES).alias("x")).collect()
    rows.sort(key=lambda r: list(r["x"]))
    return Filter(counts, prior, fit(np.array([r["x"] for r in rows], dtype=np.float64),
                                     np.array([r["block"] for r in rows], dtype=np.float64)))


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every page.

    ``labelled`` has (url, block): the URLs to learn from; by default those that a rule decides.
    """
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    table = _parsed(pages, F.col("page_id")).withColumns({"rule": rule, "fixed": verdict})
    if labelled is None:
        labelled = table.filter("rule IS NOT NULL").select(
            "url", (F.col("fixed") == "block").cast("int").alias("block"))
    judged = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return learn(labelled).score(table).select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", judged).alias("verdict"), "block_score")
