"""Feature tables and corpus-wide token weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from echofind.functions.batches import batch_words
from echofind.functions.features import (
    ngram_set,
    spaced_vector_tokens,
    token_frequency,
    token_set,
)
from echofind.operators.dictionary import flat, in_blocks, sums
from echofind.operators.joins import join_lookup
from echofind.sources.store import stored

FEATURE_METHODS = ("ngram", "token", "frequency", "vectorize")
#: Documents whose distinct tokens are counted together.
COUNT_ROWS = 2_048
TERM_FIELDS = [StructField(c, ArrayType(LongType())) for c in ("names", "tf")]
SEEN_FIELD = StructField(
    "seen", ArrayType(StructType([StructField("token", StringType()), StructField("name", LongType()), StructField("df", LongType())]))
)
PART_SCHEMA = StructType([StructField("name", LongType()), StructField("part", DoubleType())])


def _token_counts(docs: DataFrame, text: Column | str, id_col: str, terms: bool = True) -> DataFrame:
    """``(id, names, tf)`` of every document and, on one row of each ``COUNT_ROWS``, ``seen``: their distinct tokens with name and df.

    Tokens are counted in Arrow batches of texts and named by 64 bits of MD5. Without ``terms``
    the rows have ``seen`` alone.
    """
    spaced = docs.select(F.col(id_col), spaced_vector_tokens(text).alias("_text"))
    kept = [*([spaced.schema[id_col], *TERM_FIELDS] if terms else []), SEEN_FIELD]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, COUNT_ROWS):
                batch = whole.slice(first, COUNT_ROWS)
                found = batch_words(batch.column(1), least=2)
                names = found.names()
                df = np.bincount(found.code, minlength=len(names))
                seen = pa.StructArray.from_arrays([found.words, pa.array(names), pa.array(df, pa.int64())], ["token", "name", "df"])
                edge = np.full((batch.num_rows if terms else 1) + 1, len(names))
                edge[0] = 0
                columns = [batch.column(0), found.lists(names[found.code]), found.lists(found.count)] if terms else []
                listed = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), seen)
                yield pa.RecordBatch.from_arrays([*columns, listed], [f.name for f in kept])

    return spaced.mapInArrow(work, StructType(kept))


def _frequencies(counted: DataFrame) -> DataFrame:
    """``(token, name, df)`` from ``seen``."""
    each = counted.select(F.explode("seen").alias("s")).select("s.*")
    return each.groupBy("token", "name").agg(F.sum("df").alias("df"))


def _with_idf(frequency: DataFrame, docs: DataFrame) -> DataFrame:
    total = docs.select(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    return frequency.select(
        "name", "token", (F.log((total + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")
    )


def idf_token_weights(docs: DataFrame, text: Column | str = "text", id_col: str = "doc_id") -> DataFrame:
    """Smoothed inverse document frequency of every vocabulary token."""
    frequency = _frequencies(_token_counts(docs, text, id_col, terms=False))
    return _with_idf(frequency, docs).select("token", F.col("idf").alias("weight"))


def tfidf_token_weights(docs: DataFrame, text: Column | str = "text", id_col: str = "doc_id") -> DataFrame:
    """TF-IDF score of every token summed over all documents.

    Smoothed idf, rows scaled to unit length. Word counts are stored first, under 64-bit names. Each document then travels
    once, as 64-bit names and counts, and meets the idf of its block's distinct words; a block
    yields one partial sum for each word.
    """
    terms = stored(_token_counts(docs, text, id_col))
    vocabulary = stored(_with_idf(_frequencies(terms), terms))

    def unit_sums(rows: pd.DataFrame, edge: np.ndarray, names: np.ndarray, at: np.ndarray, entries: pd.DataFrame) -> pd.DataFrame:
        score = flat(rows["tf"]) * entries["idf"].to_numpy(float)[at] if len(names) else np.zeros(0)
        norm = np.sqrt(sums(score * score, edge))
        unit = score / np.repeat(norm, np.diff(edge))
        return pd.DataFrame({"name": entries["name"], "part": np.bincount(at, unit, len(entries))})

    parts = in_blocks(terms.select(id_col, "names", "tf"), vocabulary.select("name", "idf"), unit_sums, PART_SCHEMA, id_col)
    weights = parts.groupBy("name").agg(F.sum("part").alias("weight"))
    return join_lookup(vocabulary.select("name", "token"), weights, ["name"]).select("token", "weight")


def extract_features(
    docs: DataFrame,
    method: str = "ngram",
    n: int = 3,
    text: str = "text",
    id_col: str = "doc_id",
    vectorizer: Callable[[DataFrame, str, str], DataFrame] | None = None,
) -> DataFrame:
    """Features by method.

    ``ngram`` and ``token`` give ``(id, features array<string>)``, ``frequency``
    gives ``(id, features array<struct<token,tf>>)`` and ``vectorize`` gives the
    corpus table ``(token, weight)``; a ``vectorizer`` function replaces TF-IDF.
    """
    if method == "ngram":
        return docs.select(id_col, ngram_set(text, n).alias("features"))
    if method == "token":
        return docs.select(id_col, token_set(text).alias("features"))
    if method == "frequency":
        return docs.select(id_col, token_frequency(text).alias("features"))
    if method == "vectorize":
        return (vectorizer or tfidf_token_weights)(docs, text, id_col)
    raise ValueError(f"features are one of {FEATURE_METHODS}, not {method!r}")
