"""The corpus pipeline: five stages from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents; all but the last return the columns of documents. Nulls,
empty texts, repeated rows and empty tables are treated as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintora.llm import (decontamination, language_id, near_duplicates, packing, substring_dedup)
from vintora.llm.common import read, stored
from vintora.llm.registry import tokenizer_path
from vintora.session import prepare

#: Documents whose largest pooled probability is below this go. With K languages that one is at least
#: 1/K: up to three languages it rejects nothing with a letter, with four only what is almost uniform.
LEAST_SCORE = 0.3

# Networks and graphs have no SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, in effect only those: junk with letters passes ``LEAST_SCORE``."""
    prepare(spark)
    return language_id.recognised(docs, LEAST_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    Rows without an id stay. Rows that repeat both id and text are one.
    """
    prepare(spark)
    gone = (near_duplicates.near_duplicates(docs).filter(~F.col("kept"))
            .select("doc_id", F.col("text_hash").alias("h")).distinct())
    whole = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("h"))
    kept = whole.join(gone, ["doc_id", "h"], "left_anti")
    first = Window.partitionBy("doc_id", "h").orderBy("doc_id")
    once = (kept.filter(F.col("doc_id").isNotNull())
            .withColumn("n", F.row_number().over(first)).filter("n = 1").select("row.*"))
    return once.unionByName(kept.filter(F.col("doc_id").isNull()).select("row.*"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated passages and lines are cut out; ``n_chars`` follows the text."""
    prepare(spark)
    cut = substring_dedup.deduplicated(docs, spans_as=None, whole_lines=True)
    if "n_chars" in cut.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    prepare(spark)
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    prepare(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
