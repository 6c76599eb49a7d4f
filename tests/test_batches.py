"""Words counted and hashed in Arrow batches equal the column expressions."""

import pytest
from pyspark.sql import functions as F

from echofind.functions.features import count_elements, token_set, vector_tokens
from echofind.functions.text import words
from echofind.operators import features, fingerprint

TEXTS = [
    "a bb a  ccc_1 bb", "", None, " ", "x", "Ünïcode ÄÄ ää ΟΔΟΣ οδος", "co-op résumé é", "\U00020000 \U00020000\U00020001 z",
    "tab\tnew\nline hard em", "İstanbul ISTANBUL", "½ ½½ ①② ٣٤ _ __", "a" * 80 + " " + "é" * 40, "word " * 300, "<p>!?</p>",
]


def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(2)


@pytest.mark.parametrize("rows", [1, 4, 2048])
def test_token_counts_equal_the_expressions(spark, monkeypatch, rows):
    monkeypatch.setattr(features, "COUNT_ROWS", rows)
    docs = corpus(spark)
    counted = features._token_counts(docs, "text", "doc_id").cache()
    named = {r["name"]: r["token"] for r in features._frequencies(counted).collect()}
    found = {r["doc_id"]: {named[n]: c for n, c in zip(r["names"] or [], r["tf"] or [])} for r in counted.collect()}
    plain = docs.select("doc_id", count_elements(vector_tokens("text")).alias("c")).collect()
    assert found == {r["doc_id"]: {t["token"]: t["tf"] for t in r["c"] or []} for r in plain}
    df = {r["token"]: r["df"] for r in features._frequencies(features._token_counts(docs, "text", "doc_id", terms=False)).collect()}
    assert df == {t: sum(t in tokens for tokens in found.values()) for t in named.values()}


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("bits", [24, 33, 64])
def test_weighted_words_equal_weighted_arrays(spark, monkeypatch, method, distinct, bits):
    monkeypatch.setattr(fingerprint, "WORD_ROWS", 3)
    docs = corpus(spark).withColumn("digest", F.md5("text"))
    weights = spark.createDataFrame([("bb", 2.5), ("word", 0.25), ("Ünïcode", 3.0), (None, 9.0)], "token string, weight double")
    listed = token_set("text") if distinct else words("text")
    args = {"hash_bits": bits, "keep": ("digest",), "hash_method": method}
    plain = fingerprint.simhash_weighted(docs, weights, listed, **args)
    found = fingerprint.simhash_weighted(docs, weights, fingerprint.WordGrams("text", 1, distinct), **args)
    assert sorted(found.collect(), key=lambda r: r["doc_id"]) == sorted(plain.collect(), key=lambda r: r["doc_id"])


def test_documents_keep_one_array_of_hashes(spark, monkeypatch):
    seen = []
    for module in (features, fingerprint):
        real = module.stored
        monkeypatch.setattr(module, "stored", lambda df, real=real: seen.append(df.dtypes) or real(df))
    docs = corpus(spark)
    fingerprint.simhash_weighted(docs, features.tfidf_token_weights(docs), fingerprint.WordGrams("text", 1, True))
    assert ("names", "array<bigint>") in seen[-1] and len(seen[-1]) == 2
    assert not any(kind == "array<string>" for table in seen for _, kind in table)


def test_document_frequencies_come_counted_from_the_batches(spark):
    docs = corpus(spark).coalesce(1)
    counted = features._token_counts(docs, "text", "doc_id", terms=False)
    assert counted.columns == ["seen"] and counted.count() == 1
    plan = features.idf_token_weights(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "array_distinct" not in plan
