"""The corpus pipeline: five stages, each an operator of ``echofind.llm`` at work on the documents that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echofind.llm import credentials, decontaminate, jaccard_join, packing, toxicity
from echofind.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below 0.7. It learns from the labels of the rows it is given."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8; those of no words stay."""
    return jaccard_join.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark text was found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by their kind in brackets; n_chars follows the text."""
    clean = credentials.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in a batch; its length is its number of words."""
    sized = docs.select("doc_id", packing.word_length(F.col("text")).alias("words"))
    return packing.pack(sized, F.col("words")).drop("words")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", redact_secrets),
    ("packing", pack_batches),
]

#: The trees of the first stage have no SQL; tests/llm/test_corpus_pipeline.py holds every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
