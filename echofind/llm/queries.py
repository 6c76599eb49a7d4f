"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echofind.llm import (
    chunk_dedup, credentials, decontaminate, grid_codes, jaccard_join, nearest, packing, pii, pivot_join, suffix_dedup, token_count, toxicity, whitening,
)
from echofind.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), keep_text=False)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.select("doc_id", packing.word_length(F.col("text")).alias("words"))
    return packing.pack(sized, F.col("words")).drop("words")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_join.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_decontamination, op3_token_counts, op4_jaccard_join, op5_chunk_dedup,
        op6_nearest, op7_suffix_dedup, op8_packing, op9_secrets, op10_toxicity,
        op11_whitening, op12_grid_codes, op13_simhash_pivots,
    )
}
