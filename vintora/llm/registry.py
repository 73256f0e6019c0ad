"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintora.llm import (checks, collocations, decontamination, language_id, license_scan, merkle,
                         near_duplicates, packing, quality_cotraining, secret_scan, sharding,
                         substring_dedup, url_filter, vector_search)
from vintora.llm.common import read
from vintora.session import prepare


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(prepare(spark), sf_dir, "documents"), tokenizer_path())


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read(prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", F.concat_ws(" ", "licences").alias("licences"), "spans",
                        F.concat_ws(" ", "unmatched").alias("unmatched"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.deduplicated(docs, whole_lines=True)


URL_RULES = [url_filter.Rule("net/", "block"), url_filter.Rule("example.net/en/", "allow"),
             url_filter.Rule("example.com/de/", "block"), url_filter.Rule("org/fr/", "allow")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(prepare(spark), sf_dir, "pages"), URL_RULES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.contaminated(read(spark, sf_dir, "documents"),
                                        read(spark, sf_dir, "benchmark"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.integer_vectors(read(prepare(spark), sf_dir, "embeddings"),
                                            "vec_id", "embedding")
    found = vector_search.top_k(vectors, vectors.filter(F.col("id") % 50 == 0), 5)
    return found.select("query_id", "rank", "vec_id", "score")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(prepare(spark), sf_dir, "documents"))


def op8_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = quality_cotraining.describe(read(prepare(spark), sf_dir, "documents"))
    model = quality_cotraining.learn(views, read(spark, sf_dir, "labels"))
    return quality_cotraining.score(views, model)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(prepare(spark), sf_dir, "documents"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(
        read(prepare(spark), sf_dir, "documents")).drop("text_hash")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(read(prepare(spark), sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(prepare(spark), sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_license_scan, op3_substring_dedup, op4_url_filter,
    op5_decontamination, op6_exact_topk, op7_sharding, op8_quality_cotraining, op9_language_id,
    op10_minhash_dedup, op11_merkle_manifest, op12_secret_scan,
    op13_phrase_collocations)}

ORACLE: dict[str, str] = {
    "op10_minhash_dedup": checks.NEAR_DUPLICATES,
    "op11_merkle_manifest": checks.MERKLE,
    "op12_secret_scan": checks.SECRETS,
    "op13_phrase_collocations": checks.COLLOCATIONS,
    "op6_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM r WHERE rank <= 5""",
}
