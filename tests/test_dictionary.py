import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from echofind.operators import evaluate, features, fingerprint
from echofind.operators.dictionary import in_blocks, sums

EDGES = [(1, [3, 3, 5]), (2, []), (3, None), (4, [9]), (5, list(range(40)))]


def value_sums(spark, rows, lookup, block_names):
    docs = spark.createDataFrame(rows, "doc_id bigint, names array<bigint>")
    table = spark.createDataFrame(lookup, "name bigint, value bigint")

    def kernel(block, edge, names, at, entries):
        values = np.where(at >= 0, entries["value"].to_numpy(np.int64)[at] if len(entries) else 0, -1000)
        return pd.DataFrame({"doc_id": block["doc_id"], "n": np.diff(edge), "total": sums(values, edge)})

    found = in_blocks(docs, table, kernel, "doc_id bigint, n bigint, total bigint", block_names=block_names).collect()
    assert len(found) == len(rows)
    return {r["doc_id"]: (r["n"], r["total"]) for r in found}


@pytest.mark.parametrize("block_names", [1, 4_000_000])
def test_blocks_equal_plain_lookup(spark, block_names):
    table = {3: 7, 9: 11, **{k: k for k in range(10, 20)}}
    expected = {i: (len(n or []), sum(table.get(x, -1000) for x in n or [])) for i, n in EDGES}
    assert value_sums(spark, EDGES, list(table.items()), block_names) == expected


def test_blocks_without_dictionary_or_rows(spark):
    assert value_sums(spark, [(1, [4, 5]), (2, [])], [], 1) == {1: (2, -2000), 2: (0, 0)}
    assert value_sums(spark, [], [(1, 1)], 1) == {}


def test_one_element_in_every_document_is_one_entry_a_block(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.array(F.lit(1).cast("bigint")).alias("names"))
    seen = in_blocks(
        docs,
        spark.createDataFrame([(1, 1)], "name bigint, value bigint"),
        lambda block, edge, names, at, entries: pd.DataFrame({"rows": [len(block)], "entries": [len(entries)]}),
        "rows bigint, entries bigint",
        block_names=100,
    ).collect()
    assert sum(r["rows"] for r in seen) == 5000
    assert len(seen) > 40 and {r["entries"] for r in seen} == {1}


def test_weights_of_texts_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(in_blocks, "__defaults__", ("doc_id", 50))
    draw = random.Random(3)
    texts = [" ".join(draw.choices([f"w{k}" for k in range(30)], k=draw.randint(0, 40))) for _ in range(60)] + ["", None, "x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = [Counter((t or "").split()) for t in texts]
    counts[-1] = Counter()  # one character is no word here
    df = Counter(w for c in counts for w in c)
    idf = {w: math.log((len(texts) + 1) / (n + 1)) + 1 for w, n in df.items()}
    expected = defaultdict(float)
    for c in counts:
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items()))
        for w, n in c.items():
            expected[w] += n * idf[w] / norm
    found = {r["token"]: r["weight"] for r in features.tfidf_token_weights(frame).collect()}
    assert found == pytest.approx(dict(expected))


def test_weighted_votes_keep_repeats_and_columns(spark, monkeypatch):
    monkeypatch.setattr(in_blocks, "__defaults__", ("doc_id", 2))
    rows = [(1, ["a", "a", "b"], "x"), (2, ["b", "c"], None), (3, [], "y"), (4, None, "z"), (5, ["a", None], "n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, features array<string>, names string")
    kept = frame.withColumnRenamed("names", "digest")
    weights = spark.createDataFrame([("a", 0.4), ("c", 3.0), ("d", None)], "token string, weight double")
    found = {r["doc_id"]: r for r in fingerprint.simhash_weighted(kept, weights, hash_bits=24, keep=("digest",)).collect()}
    hashes = {r["f"]: r["h"] for r in spark.createDataFrame([("a",), ("b",), ("c",)], "f string").select("f", fingerprint.feature_hash("f", 24).alias("h")).collect()}
    units = {"a": 400_000, "b": 1_000_000, "c": 3_000_000}
    for doc_id, names, digest in rows:
        present = [f for f in names or [] if f is not None]
        total = sum(units[f] for f in present)
        bits = sum((2 * sum(units[f] for f in present if hashes[f] >> i & 1) > total) << i for i in range(24))
        assert (found[doc_id]["signature"], found[doc_id]["digest"]) == (bits, digest)


def test_exact_pairs_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(in_blocks, "__defaults__", ("doc_id", 20))
    draw = random.Random(5)
    sets = {i: draw.sample([f"e{k}" for k in range(25)], draw.randint(0, 12)) for i in range(50)}
    frame = spark.createDataFrame(list(sets.items()), "doc_id bigint, features array<string>")
    found = {(r["id1"], r["id2"]) for r in evaluate.exact_similar_pairs(frame, threshold=0.5).collect()}
    plain = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]}
    assert found == {(a, b) for a, b in plain if 2 * len(set(sets[a]) & set(sets[b])) >= len(set(sets[a]) | set(sets[b]))}


def test_no_occurrence_meets_a_corpus_wide_table(spark):
    frame = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"])], "doc_id bigint, features array<string>")
    weights = spark.createDataFrame([("a", 2.0)], "token string, weight double")
    plan = fingerprint.simhash_weighted(frame, weights)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "Window" not in plan
    # The dictionary is made distinct before it is shuffled; nothing else is exploded.
    assert plan.count("Generate explode") == 1
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    above = [line for line in lines[:at] if "HashAggregate" in line or "Exchange" in line]
    assert "HashAggregate" in above[-1]
