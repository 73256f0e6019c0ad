"""Secrets in whole texts, with Spark expressions only: known forms and a battery of randomness tests.

Known forms are matched from left to right without overlaps. A text is split at the matches of a
form, so a match begins where the parts and matches before it end; positions are code points.

The battery judges every other long run of token characters. Its encoding is inferred from the
characters that occur, and with it the alphabet of k symbols. With n characters (padding left out):

* chi-squared uniformity, ``k/n * sum(count^2) - n``, against its exact mean and variance;
* Wald-Wolfowitz runs of symbols of the lower and the upper half of the alphabet;
* serial correlation of neighbouring symbol numbers, the last with the first.

The squares of the three standardised values add up to about a chi-squared value of three degrees of
freedom; a run above ``BATTERY`` is not random and drops out. What passes may still be a short piece
of text, for which the tests are weak. So each run is also tested against being text: language repeats
its letters, which raises chi-squared by ``(n - 1) * excess``, more so the longer the run. The
standardised distance below that value is the evidence, and the Benjamini-Hochberg rule holds the
share of text among the accepted runs at ``FALSE_SHARE`` in each band of lengths, over all documents.
Evidence is kept in thousandths, so the rule needs only counts per band and thousandth.

All arithmetic up to that point is on whole numbers, quotients and square roots, which every engine
rounds alike.

Defined results: a null text is empty and has no spans. Rows repeat as they are. Other columns are
ignored. Without any run of token characters only known forms are found; an empty table has no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintora.llm.common import stored


class Form(NamedTuple):
    kind: str
    pattern: str
    least: int       # characters of the group
    group: int


# The known forms, in the order of their kinds.
FORMS = [
    Form("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Form("access", "AKIA[A-Z0-9]+", 20, 0),
    Form("hex", "[0-9a-f]{24,}", 24, 0),       # the longer ones of all runs
]
RANDOM = "random"
RUN = "[A-Za-z0-9+/_-]{20,}=*"


class Encoding(NamedTuple):
    name: str
    pattern: str
    symbols: str
    excess: float    # symbols * (chance that two letters of text are equal) - 1


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
# Two letters of running text are equal with a chance of 0.066; in hexadecimal text,
# which is mostly decimal numbers, two symbols with 0.1. The first encoding that fits counts.
# No test tells random digits from an account number, so decimal runs are left out.
ENCODINGS = [
    Encoding("hex", "^[0-9a-f]+$", _DIGITS + "abcdef", 16 * 0.1 - 1),
    Encoding("hex", "^[0-9A-F]+$", _DIGITS + "ABCDEF", 16 * 0.1 - 1),
    Encoding("letters", "^[a-z]+$", _LOWER, 26 * 0.066 - 1),
    Encoding("letters", "^[A-Z]+$", _LOWER.upper(), 26 * 0.066 - 1),
    Encoding("base32", "^[A-Z2-7]+$", _LOWER.upper() + "234567", 32 * 0.066 - 1),
    Encoding("base36", "^[0-9a-z]+$", _DIGITS + _LOWER, 36 * 0.066 - 1),
    Encoding("base36", "^[0-9A-Z]+$", _DIGITS + _LOWER.upper(), 36 * 0.066 - 1),
    Encoding("base62", "^[0-9A-Za-z]+$", _DIGITS + _LOWER.upper() + _LOWER, 62 * 0.066 - 1),
    Encoding("base64", "^[0-9A-Za-z+/]+$", _LOWER.upper() + _LOWER + _DIGITS + "+/", 64 * 0.066 - 1),
    Encoding("base64url", "", _LOWER.upper() + _LOWER + _DIGITS + "-_+/", 66 * 0.066 - 1),
]
DECIMAL = "^[0-9]+$"
BANDS = (32, 64)         # lengths from which the second and the third band begin
BATTERY = 16.266         # chi-squared of three degrees of freedom at 0.001
FALSE_SHARE = 0.01
_CHUNK = 512


def _starts(lengths: Column) -> Column:
    """The sums of all members before each one, for arrays of any size.

    Sums run inside chunks and over chunks, so that growing the result copies little.
    """
    chunks = F.transform(
        F.sequence(F.lit(0), (F.size(lengths) / _CHUNK).cast("int")),
        lambda i: F.slice(lengths, i * _CHUNK + 1, _CHUNK))
    empty = F.array().cast("array<int>")

    def grow(acc: Column, n: Column) -> Column:
        return F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def chunk(acc: Column, some: Column) -> Column:
        inside = F.aggregate(some, F.struct(acc["at"].alias("at"), empty.alias("out")), grow)
        return F.struct(inside["at"].alias("at"),
                        F.concat(acc["out"], F.array(inside["out"])).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
    return F.flatten(F.aggregate(chunks, start, chunk, lambda acc: acc["out"]))


def _spans(text: Column, hits: Column, pattern: str) -> Column:
    """Array of (start, end, hit), code points; ``hits`` are all matches of the pattern."""
    def place() -> Column:
        parts = F.transform(F.split(text, pattern, -1), F.length)
        sizes = F.transform(hits, F.length)
        # Part, match, part, match: every second start is a match's.
        both = F.flatten(F.zip_with(F.slice(parts, 1, F.size(hits)), sizes, lambda a, b: F.array(a, b)))
        starts = F.filter(_starts(both), lambda _, i: i % 2 == 1)
        return F.zip_with(starts, hits, lambda at, hit: F.struct(
            at.alias("start"), (at + F.length(hit)).alias("end"), hit.alias("hit")))

    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(F.size(hits) > 0, place()).otherwise(none)


def _run_columns(df: DataFrame) -> DataFrame:
    """From ``word`` (no padding) the three standardised values and the evidence, step by step."""
    def first_fit(value) -> Column:
        out = None
        for e in ENCODINGS[:-1]:
            fits = F.col("word").rlike(e.pattern)
            out = F.when(fits, value(e)) if out is None else out.when(fits, value(e))
        return out.otherwise(value(ENCODINGS[-1]))

    df = df.withColumns({
        "n": F.length("word").cast("double"), "letters": F.split("word", ""),
        "symbols": first_fit(lambda e: F.lit(e.symbols)), "excess": first_fit(lambda e: F.lit(e.excess))})
    df = df.withColumns({
        "k": F.length("symbols").cast("double"),
        "codes": F.transform("letters", lambda c: F.position(c, F.col("symbols")) - 1),
        "squares": F.aggregate(F.array_distinct("letters"), F.lit(0).cast("bigint"), lambda a, c: a + F.pow(
            F.length("word") - F.length(F.replace(F.col("word"), c, F.lit(""))), F.lit(2)).cast("bigint"))})
    df = df.withColumns({
        "upper": F.transform("codes", lambda c: (c * 2 >= F.col("k")).cast("int")),
        "chi": F.col("k") * F.col("squares") / F.col("n") - F.col("n"),
        "next": F.concat(F.slice("codes", 2, F.length("word")), F.slice("codes", 1, 1))})
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
    df = df.withColumns({
        "ones": total("upper"),
        "runs": total(F.zip_with(F.slice("upper", 1, F.length("word") - 1),
                                 F.slice("upper", 2, F.length("word")),
                                 lambda a, b: F.abs(a - b))) + 1,
        "sum": total("codes"),
        "sum2": total(F.transform("codes", lambda c: c * c)),
        "lag": total(F.zip_with("codes", "next", lambda a, b: a * b))})
    n, k = F.col("n"), F.col("k")
    pairs = F.lit(2.0) * F.col("ones") * (n - F.col("ones"))
    spread = n * F.col("sum2") - F.col("sum") * F.col("sum")
    df = df.withColumns({
        "pairs": pairs, "spread": spread,
        "z_chi": (F.col("chi") - (k - 1)) / F.sqrt(F.lit(2.0) * (k - 1) * (n - 1) / n)})
    run_var = F.col("pairs") * (F.col("pairs") - n) / (n * n * (n - 1))
    r = (n * F.col("lag") - F.col("sum") * F.col("sum")) / F.col("spread")
    df = df.withColumns({
        "z_runs": F.when((F.col("pairs") > 0) & (F.col("pairs") > n),
                         (F.col("runs") - F.col("pairs") / n - 1) / F.sqrt(run_var)),
        "z_serial": F.when(F.col("spread") > 0, (r + F.lit(1.0) / (n - 1)) * (n - 1) * F.sqrt(n - 2) / n)})
    battery = (F.col("z_chi") * F.col("z_chi") + F.col("z_runs") * F.col("z_runs")
               + F.col("z_serial") * F.col("z_serial"))
    shift = (n - 1) * F.col("excess")
    evidence = (k - 1 + shift - F.col("chi")) / F.sqrt(F.lit(2.0) * (k - 1) + F.lit(4.0) * shift)
    return df.withColumns({
        "passed": F.coalesce(battery <= BATTERY, F.lit(False)),
        "band": (n >= BANDS[0]).cast("int") + (n >= BANDS[1]).cast("int"),
        "score": F.floor(evidence * 1000).cast("int")})


def tested(runs: DataFrame) -> DataFrame:
    """(id, start, end, band, score, passed) of rows with ``id``, ``start``, ``end`` and ``hit``."""
    words = runs.withColumn("word", F.rtrim(F.col("hit"), F.lit("="))).filter(~F.col("word").rlike(DECIMAL))
    return _run_columns(words).select("id", "start", "end", "band", "score", "passed")


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution for z >= 0, to seven places."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * z)
    # Coefficients of the approximation.
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (
        -1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / F.lit(2.5066282746310002) * series


def limits(runs: DataFrame) -> DataFrame:
    """(band, least): the evidence from which on a band's runs are accepted, at most three rows.

    What is sorted are the distinct thousandths of a band, not its runs.
    """
    cells = runs.groupBy("band", "score").agg(F.count(F.lit(1)).alias("runs"))
    down = Window.partitionBy("band").orderBy(F.desc("score"))
    whole = Window.partitionBy("band")
    ranked = cells.withColumns({"rank": F.sum("runs").over(down), "all": F.sum("runs").over(whole)})
    holds = (F.col("score") >= 0) & (
        tail(F.col("score") / 1000) * F.col("all") <= FALSE_SHARE * F.col("rank"))
    return ranked.filter(holds).groupBy("band").agg(F.min("score").alias("least"))


def _of_form(i: int, form: Form) -> Column:
    """The spans of a form whose group is long enough."""
    kept = F.filter(f"spans{i}", lambda s: F.length(
        F.regexp_extract(s["hit"], form.pattern, form.group)) >= form.least)
    return F.transform(kept, lambda s: F.struct(
        s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))


def _count(i: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")


def scan(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id_column, base, random): spans (start, kind, end) by start, ``kind`` counted from 0."""
    text = F.coalesce("text", F.lit(""))
    patterns = [f.pattern for f in FORMS] + [RUN]
    found = docs.select(F.col(id_column).alias(id_column), text.alias("text")).withColumns(
        {f"hits{i}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for i, p in enumerate(patterns)})
    found = found.select(id_column, *[
        _spans(F.col("text"), F.col(f"hits{i}"), p).alias(f"spans{i}") for i, p in enumerate(patterns)])
    base = [_of_form(i, form) for i, form in enumerate(FORMS)]
    rows = stored(found.select(
        id_column, F.monotonically_increasing_id().alias("id"), F.array_sort(F.concat(*base)).alias("base"),
        F.col(f"spans{len(FORMS)}").alias("runs")), "secrets")
    judged = stored(tested(rows.filter(F.size("runs") > 0).select("id", F.inline("runs"))), "runs")
    # Three rows at most.
    accepted = judged.filter("passed").join(F.broadcast(limits(judged)), "band").filter(
        F.col("score") >= F.col("least"))
    random = accepted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(FORMS)).alias("kind"), "end"))).alias("random"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.join(random, "id", "left").select(
        id_column, "base", F.coalesce("random", none).alias("random"))


def written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in [*(f.kind for f in FORMS), RANDOM]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of the known forms, a digest of their spans, and all spans in writing."""
    found = scan(docs)
    return found.select("doc_id", *[
        _count(i).alias(f"n_{form.kind}") for i, form in enumerate(FORMS)],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "random"))).alias("spans"))
