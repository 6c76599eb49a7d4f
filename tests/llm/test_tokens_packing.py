"""Token counts against the library, packing against exhaustive search."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from echofind.llm import packing, token_count

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [None, "", " ", "  ", " a", "a ", "hello  world", "a\tb\n\nc ", "<s> x </s> <unk> <0x41>", "\x00a", "é́漢字🦀", "a▁b ▁ c", "\n", "x" * 5000, " " * 300 + "y", "Trailing.\nNext, line"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=token_count.model_path())


def test_counts_equal_the_library(spark, library):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens long")
    rows = {r["doc_id"]: r for r in token_count.count_tokens(df, limit=100).collect()}
    for i, text in enumerate(TEXTS):
        want = len(library.encode(text or ""))
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"], rows[i]["over_limit"]) == (want, len((text or "").encode()), want > 100)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abeinst. ,▁\né漢'-0")), max_size=60))
def test_any_text(library, text):
    assert token_count.fragments(token_count.model_path()).count(text) == len(library.encode(text))


UNITS = ["1234567890", "aZ3+/", "漢", "字", "🦀", "é́", "Жшщ", "x", "ab", "=", "\n", "▁", " ", "\x00", "\U0010ffff"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(UNITS) | st.text(min_size=1, max_size=8), st.integers(1, 4000)), min_size=1, max_size=3))
def test_long_unbroken_texts(library, runs):
    text = "".join(unit * n for unit, n in runs)[:20_000]
    assert token_count.fragments(token_count.model_path()).count(text) == len(library.encode(text))


def test_memory_of_fragments(library, monkeypatch):
    """Long fragments are not remembered, and what is remembered stays within its bound."""
    counter = token_count.Fragments(token_count.fragments(token_count.model_path()).ranks)
    for text in ("漢" * 5000, "x" * 20_000, "1234567890" * 2000):
        assert counter.count(text) == len(library.encode(text))
    assert sum(map(len, counter)) < 200
    monkeypatch.setattr(token_count, "MEMO_BYTES", 5_000)
    for i in range(400):
        counter.count(f"w{i}q z{i}")
    assert counter.held <= 5_000 and len(counter) < 40


def test_repeated_rows(spark, library):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "漢字")], "doc_id long, text string")
    got = [tuple(r) for r in token_count.count_tokens(df).collect()]
    assert sorted(got, key=str) == sorted([(i, len(t.encode()), len(library.encode(t)), False) for i, t in ((1, "a b"), (1, "a b"), (None, "漢字"))], key=str)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 10))
def test_boundaries_are_optimal(cells, buckets):
    lengths = np.array(sorted(cells))
    counts = np.array([cells[n] for n in lengths])

    def padding(tops):
        return sum(c * (min(t for t in tops if t >= n) - n) for n, c in zip(lengths, counts, strict=True))

    best = min(padding({*some, lengths[-1]}) for k in range(min(buckets, len(lengths))) for some in itertools.combinations(lengths[:-1], k))
    tops = packing.boundaries(lengths, counts, lengths * counts, buckets)
    assert len(tops) <= buckets
    assert padding(tops) == best


def test_packing_keeps_every_row(spark):
    texts = [("w " * n).strip() for n in (*range(0, 300, 7), *[5] * 400, 3000)] + [None, ""]
    rows = [(i % 440, t, "b", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 7, 8, 9, 10) for r in rows], "doc_id long, text string, bucket string, batch int, _shard int, _at int, _n int, _offset int")
    got = packing.pack(df, packing.word_length(F.col("text")), budget=500, buckets=4, shard_rows=50).toPandas()
    assert sorted(got["length"]) == sorted(len((t or "").split()) for t in texts)
    assert not got.duplicated(["bucket", "batch", "slot"]).any()
    assert (got[["_shard", "_at", "_n", "_offset"]] == [7, 8, 9, 10]).all().all()
    over = got[got["length"] > 500]
    assert (over["boundary"] == over["length"]).all() and (over["padding"] == 0).all() and (over["slot"] == 0).all()
    assert (got["boundary"] >= got["length"]).all() and got[got["length"] <= 500]["boundary"].nunique() <= 4
    sizes = got.groupby(["bucket", "batch"]).agg(n=("slot", "size"), top=("boundary", "first")).reset_index()
    assert ((sizes["n"] * sizes["top"] <= 500) | (sizes["n"] == 1)).all()
    for _, group in sizes[sizes["top"] <= 500].groupby("bucket"):
        full = np.maximum(1, 500 // group["top"].clip(lower=1))
        assert (group["n"] < full).sum() <= 1  # only the last batch of a bucket


def test_boundaries_of_all_lengths(spark):
    """Every length up to the budget is a cell of its own, so the boundaries are the best there are."""
    lengths = [1, 1500, 1501, 1502, 1503, 1503, 1900, 1901, 9000]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n long")
    assert packing.plan(df, F.col("n"), 3, 2000) == [1, 1503, 1901]
    got = packing.pack(df, F.col("n"), budget=2000, buckets=3).toPandas()
    assert got["padding"].sum() == 3 + 2 + 1 + 1 and set(got["boundary"]) == {1, 1503, 1901, 9000}


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, n long"), F.col("n")).count() == 0
    assert token_count.count_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0
