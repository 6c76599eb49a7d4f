"""Signatures against per-document Python restatements of their definitions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from echofind.functions import features, hashing, text
from echofind.operators import fingerprint
from echofind.plans.pipeline import Options, compute_signatures

PRIME = 2**31 - 1


def base_hash(feature: str, bits: int = 32) -> int:
    digest = hashlib.md5(feature.encode()).hexdigest()
    value = int(digest[:8], 16) | int(digest[8:16], 16) << 32
    return value & ((1 << bits) - 1)


def unsigned(value: int) -> int:
    return value & (2**64 - 1)


def majority(weights: dict[str, int], bits: int) -> int:
    signature = 0
    for i in range(bits):
        vote = sum(w if base_hash(f, bits) >> i & 1 else -w for f, w in weights.items())
        signature |= (vote > 0) << i
    return signature


@pytest.fixture(scope="module")
def sets(spark):
    rows = [
        (1, ["apple", "banana", "cherry"]),
        (2, ["banana", "cherry", "date"]),
        (3, ["apple", "banana", "cherry"]),
        (4, []),
        (5, None),
        (6, ["a b c", "b c d", "c d e", "d e f"]),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, features array<string>").cache()


def by_id(frame, column="signature"):
    return {r["doc_id"]: r[column] for r in frame.collect()}


def test_minhash_signature(sets):
    params = hashing.minhash_params(16, 7)
    actual = by_id(fingerprint.minhash_signature(sets, num_hashes=16, seed=7))
    for row in sets.collect():
        if not row["features"]:
            assert actual[row["doc_id"]] is None
            continue
        hashes = [base_hash(f) % PRIME for f in row["features"]]
        assert actual[row["doc_id"]] == [min((a * h + b) % PRIME for h in hashes) for a, b in params]
    assert actual[1] == actual[3]


def test_params_are_seeded():
    assert hashing.minhash_params(5, 1) == hashing.minhash_params(5, 1) != hashing.minhash_params(5, 2)
    assert hashing.sample_bit_indices(64, 16, 42) == random.Random(42).sample(range(64), 16)
    with pytest.raises(ValueError):
        hashing.sample_bit_indices(24, 32)
    with pytest.raises(ValueError):
        hashing.bit_tables(24, 2, 32)
    with pytest.raises(ValueError):
        hashing.check_hash_bits(65)


def test_minhash_similarity(spark):
    frame = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 4]), ([1], [1])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in frame.select(hashing.minhash_similarity("a", "b")).collect()] == [0.75, 1.0]
    uneven = spark.createDataFrame([([1, 2], [1])], "a array<bigint>, b array<bigint>")
    with pytest.raises(Exception, match="one length"):
        uneven.select(hashing.minhash_similarity("a", "b")).collect()


@pytest.mark.parametrize("bits", [8, 24, 32, 33, 63, 64])
def test_simhash_signature(sets, bits):
    actual = by_id(fingerprint.simhash_signature(sets, hash_bits=bits))
    for row in sets.collect():
        assert unsigned(actual[row["doc_id"]]) == majority({f: 1 for f in row["features"] or []}, bits)


def test_simhash_frequency(spark):
    frame = spark.createDataFrame([(1, "x x x y z"), (2, "")], "doc_id bigint, text string")
    counts = frame.select("doc_id", features.token_frequency("text").alias("features"))
    actual = by_id(fingerprint.simhash_frequency(counts, hash_bits=24))
    assert actual == {1: majority({"x": 3, "y": 1, "z": 1}, 24), 2: 0}


def test_simhash_weighted(spark, sets):
    weights = spark.createDataFrame([("apple", 2.5), ("date", 0.25)], "token string, weight double")
    actual = by_id(fingerprint.simhash_weighted(sets, weights, hash_bits=24))
    table = {"apple": 2_500_000, "date": 250_000}
    for row in sets.collect():
        expected = majority({f: table.get(f, 1_000_000) for f in row["features"] or []}, 24)
        assert actual[row["doc_id"]] == expected
    vectors = by_id(fingerprint.bit_vector_weighted(sets, weights, hash_bits=24), "vector")
    assert vectors == actual


@pytest.mark.parametrize("bits", [24, 64])
def test_bit_sampling(sets, bits):
    vectors = fingerprint.bit_vector_xor(sets, hash_bits=bits)
    indices = hashing.sample_bit_indices(bits, 16, 42)
    signatures = by_id(fingerprint.bit_sample_signature(vectors, 16, bits, 42))
    for row in sets.collect():
        vector = 0
        for f in row["features"] or []:
            vector ^= base_hash(f, bits)
        assert unsigned(by_id(vectors, "vector")[row["doc_id"]]) == vector
        assert signatures[row["doc_id"]] == sum((vector >> index & 1) << i for i, index in enumerate(indices))


def test_hybrid_is_both(sets):
    both = fingerprint.hybrid_signature(sets, num_hashes=16, hash_bits=24, seed=7)
    assert by_id(both, "minhash") == by_id(fingerprint.minhash_signature(sets, num_hashes=16, seed=7))
    assert by_id(both, "simhash") == by_id(fingerprint.simhash_signature(sets, hash_bits=24))


def test_binary_strings_and_distances(spark):
    frame = spark.createDataFrame([(5, 3), (-1, 0), (0, 0)], "a bigint, b bigint")
    rows = frame.select(
        hashing.signature_to_binary("a", 64).alias("text"),
        hashing.signature_from_binary(hashing.signature_to_binary("a", 64)).alias("back"),
        hashing.hamming_distance("a", "b").alias("d"),
        hashing.bit_similarity("a", "b", 64).alias("s"),
        F.col("a"),
    ).collect()
    assert [r["text"] for r in rows] == [format(unsigned(r["a"]), "064b") for r in rows]
    assert [r["back"] for r in rows] == [5, -1, 0]
    assert [r["d"] for r in rows] == [2, 64, 0]
    assert [r["s"] for r in rows] == [1 - 2 / 64, 0.0, 1.0]


@pytest.mark.parametrize("method", hashing.HASH_METHODS)
def test_estimate_is_near_exact_jaccard(spark, method):
    first, second = [f"w{i}" for i in range(300)], [f"w{i}" for i in range(100, 400)]
    frame = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, features array<string>")
    signatures = by_id(fingerprint.minhash_signature(frame, num_hashes=256, hash_method=method))
    equal = sum(x == y for x, y in zip(signatures[1], signatures[2])) / 256
    assert abs(equal - 0.5) < 0.12


def test_unknown_hash_method():
    with pytest.raises(ValueError):
        hashing.feature_hash("x", 32, "crc")


def test_results_do_not_depend_on_partitions(documents):
    docs = documents.select("doc_id", text.ngrams(text.words(text.clean_text("text")), 3).alias("features"))
    once = by_id(fingerprint.minhash_signature(docs.repartition(1), num_hashes=8))
    many = by_id(fingerprint.minhash_signature(docs.repartition(13), num_hashes=8))
    assert once == many


def test_md5_words_of_every_length():
    draw = random.Random(3)
    strings = [bytes(draw.randrange(256) for _ in range(k % 130)) for k in range(400)]
    sizes = np.array([len(s) for s in strings])
    starts = np.cumsum([0, *sizes[:-1]])
    expected = [int.from_bytes(d[:4]) | int.from_bytes(d[4:8]) << 32 for d in (hashlib.md5(s).digest() for s in strings)]
    assert hashing.md5_words(b"".join(strings), starts, sizes, 64).tolist() == expected


@pytest.fixture(scope="module")
def odd_texts(spark):
    odd = "\t a b c\x85d\x1ce  f a　b c "
    long_words = " ".join("é" * k + "x" for k in (5, 30, 60, 7, 8, 90, 5, 30, 60))
    rows = [(1, "a b c d a b c"), (2, None), (3, ""), (4, "a b"), (5, odd), (6, long_words), (None, "a b c d"), (7, "x y z"), (7, "x y z w")]
    rows += [(10 + k, " ".join(f"w{i % (40 + k)}" for i in range(300 * k))) for k in range(1, 120)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").cache()


@pytest.mark.parametrize("n", [1, 3])
def test_word_grams_are_hashed_like_arrays(odd_texts, n):
    grams, sets = fingerprint.WordGrams("text", n), fingerprint.WordGrams("text", n, distinct=True)
    for made, expected in (
        (fingerprint.minhash_signature(odd_texts, grams), fingerprint.minhash_signature(odd_texts, grams.column())),
        (fingerprint.hybrid_signature(odd_texts, sets), fingerprint.hybrid_signature(odd_texts, sets.column())),
        (fingerprint.hybrid_signature(odd_texts, sets, hash_bits=64), fingerprint.hybrid_signature(odd_texts, sets.column(), hash_bits=64)),
        (fingerprint.minhash_signature(odd_texts, grams, hash_method="xxhash64"), fingerprint.minhash_signature(odd_texts, grams.column(), hash_method="xxhash64")),
    ):
        assert sorted(map(str, made.collect())) == sorted(map(str, expected.collect()))


def test_word_grams_never_become_rows(odd_texts):
    for made in (
        fingerprint.minhash_signature(odd_texts, fingerprint.WordGrams()),
        fingerprint.hybrid_signature(odd_texts, fingerprint.WordGrams(distinct=True)),
        compute_signatures(odd_texts, Options()),
        compute_signatures(odd_texts, Options(fingerprint="hybrid")),
    ):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "MapInArrow" in plan
