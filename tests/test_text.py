"""Cleaning, tokenising and features against plain Python restatements."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from echofind.functions import features, text
from echofind.operators.features import extract_features, idf_token_weights, tfidf_token_weights

EDGE_TEXTS = [
    "",
    "   ",
    "one",
    "two words",
    "a<br>b  c - d",
    "no break　ideographic space",
    "_x_ ½ ² 漢字",
    "café naïve",
    "<p>Only body text stays!</p>",
    "Herons wait by the lock",
    "tabs\tand\nnew\r\nlines\x85next line",
    "The the THE, the; the!",
    "Ünïcode ÄÖÜ ß Straße",
]


# Expected by hand from the rule: tags go, white space becomes one space, punctuation goes, letters become small.
CLEANED = [
    "", "", "one", "two words", "ab c  d", "no break ideographic space", "_x_ ½ ² 漢字", "cafe naïve", "only body text stays",
    "herons wait by the lock", "tabs and new lines next line", "the the the the the", "ünïcode äöü ß straße",
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, value) for i, value in enumerate(EDGE_TEXTS)] + [(99, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def collected(frame, column):
    return {row["doc_id"]: row[column] for row in frame.collect()}


def test_clean_text_on_edge_rows(edge):
    actual = collected(edge.select("doc_id", text.clean_text("text").alias("c")), "c")
    assert actual == dict(enumerate(CLEANED)) | {99: None}


def test_clean_text_on_documents(documents):
    """Letters and digits keep their order, nothing else but single marks of the rule remains."""
    rows = documents.select("text", text.clean_text("text").alias("c")).collect()
    assert rows
    for r in rows:
        assert r["c"] == r["c"].lower().strip(" ") or r["c"].strip(" ") == r["c"].lower().strip(" ")
        assert not re.search(r"[^\w ]", r["c"])
        if "<" not in r["text"]:
            assert "".join(re.findall(r"\w", r["c"])) == "".join(re.findall(r"\w", r["text"])).lower()
            assert len(r["c"].split()) <= len(r["text"].split())


def test_steps(edge):
    row = edge.where("doc_id = 4").select(
        text.strip_html("text").alias("tags"), text.normalize_whitespace("text").alias("spaces")
    ).first()
    assert row["tags"] == "ab  c - d"
    assert row["spaces"] == "a<br>b c - d"


def test_stopwords_keep_order_repeats_and_case(spark):
    frame = spark.createDataFrame([(1, "the cat The dog the cat")], "doc_id bigint, text string")
    row = frame.select(
        text.remove_stopwords("text", ["the"]).alias("one"),
        text.remove_stopwords("text", []).alias("none"),
        text.tokenize("text", ["the"]).alias("tokens"),
    ).first()
    assert row["one"] == "cat The dog cat"
    assert row["none"] == "the cat The dog the cat"
    assert row["tokens"] == ["cat", "The", "dog", "cat"]


def test_stopword_lists():
    assert text.stopword_list(["b", "a", "b"], ["x"]) == ["a", "b"]
    extended = text.stopword_list(None, ["zzz"])
    assert "zzz" in extended and "the" in extended


def test_default_stopwords_are_sparks(spark):
    assert text.default_stopwords() == StopWordsRemover.loadDefaultStopWords("english")


def test_padding(edge):
    actual = collected(edge.select("doc_id", text.pad_short_text("text").alias("p")), "p")
    assert actual[0] == " This is A Filling text"
    assert actual[3] == "two words This is A Filling text"
    assert actual[9] == EDGE_TEXTS[9]
    assert actual[99] is None


def test_clean_text_config_switches(spark):
    frame = spark.createDataFrame([(1, "<b>The</b> Cat, sat down!")], "doc_id bigint, text string")
    row = frame.select(
        text.clean_text_config("text", False, False, []).alias("raw"),
        text.clean_text_config("text", stopwords=["the"]).alias("clean"),
        text.clean_text_config("text", stopwords=["the", "cat"]).alias("short"),
    ).first()
    assert row["raw"] == "The Cat, sat down!"
    assert row["clean"] == "cat sat down"
    assert row["short"] == "sat down This is A Filling text"


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_ngrams(edge, n):
    rows = edge.where("text is not null").select("text", text.ngrams(text.words("text"), n).alias("g")).collect()
    for row in rows:
        tokens = row["text"].split()
        assert row["g"] == [" ".join(tokens[i : i + n]) for i in range(len(tokens) - n + 1)]


def test_ngrams_reject_zero():
    with pytest.raises(ValueError):
        text.ngrams("tokens", 0)


def test_preprocess_record(spark):
    rows = [(1, "Here is an owl asleep."), (2, "<p>Short</p>")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    records = collected(frame.select("doc_id", text.preprocess("text", 3, stopwords=["is", "an"]).alias("r")), "r")
    assert records[1]["cleaned_text"] == "here owl asleep"
    assert records[1]["ngrams"] == ["here owl asleep"]
    # The filler is appended after stopword removal and tokenised again.
    assert records[2]["cleaned_text"] == "short This is A Filling text"
    assert records[2]["tokens"] == ["short", "This", "A", "Filling", "text"]


def test_features(edge):
    rows = edge.where("text is not null").select(
        "text",
        features.ngram_set("text", 2).alias("grams"),
        features.token_set("text").alias("tokens"),
        features.token_frequency("text").alias("tf"),
        features.token_frequency_map("text").alias("map"),
    ).collect()
    for row in rows:
        words = row["text"].split()
        assert sorted(row["grams"]) == sorted({" ".join(words[i : i + 2]) for i in range(len(words) - 1)})
        assert sorted(row["tokens"]) == sorted(set(words))
        assert {c["token"]: c["tf"] for c in row["tf"]} == dict(Counter(words)) == row["map"]


def test_extract_features_dispatch(edge):
    assert extract_features(edge, "ngram", 2).columns == ["doc_id", "features"]
    assert extract_features(edge, "token").columns == ["doc_id", "features"]
    assert extract_features(edge, "frequency").columns == ["doc_id", "features"]
    assert extract_features(edge, "vectorize").columns == ["token", "weight"]
    with pytest.raises(ValueError):
        extract_features(edge, "embedding")
    custom = extract_features(edge, "vectorize", vectorizer=lambda d, t, i: d.select(F.col(t).alias("token"), F.lit(1.0).alias("weight")))
    assert custom.count() == edge.count()


def test_tfidf_by_hand(spark):
    corpus = ["red barn by road", "red barn by a lake", "one barn burned down"]
    frame = spark.createDataFrame(list(enumerate(corpus)), "doc_id bigint, text string")
    import math

    docs = [Counter(w for w in t.split() if len(w) > 1) for t in corpus]
    df = Counter(w for d in docs for w in d)
    idf = {w: math.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items()}
    expected = Counter()
    for d in docs:
        norm = math.sqrt(sum((tf * idf[w]) ** 2 for w, tf in d.items()))
        for w, tf in d.items():
            expected[w] += tf * idf[w] / norm
    assert {r["token"]: r["weight"] for r in tfidf_token_weights(frame).collect()} == pytest.approx(dict(expected))
    assert {r["token"]: r["weight"] for r in idf_token_weights(frame).collect()} == pytest.approx(idf)


def test_words_with_and_without_odd_white_space(spark):
    from echofind.functions import text as T

    rows = [(k, t) for k, t in enumerate(["a b  c ", "  a", "", " ", None, "a\tb c", "a\u00a0b\u2028c \x85", "\x1fa  b", "a\u200bb c"])]
    frame = spark.createDataFrame(rows, "k int, text string")
    plain = F.array_remove(F.split("text", T.SPACES), "")
    found = frame.select("k", T.words("text").alias("w"), plain.alias("p")).collect()
    assert all(r["w"] == r["p"] for r in found) and len(found) == len(rows)
    marks = "a-b, c.d!? \u00e9\u2019\u2014x _y (z) \u4e2d\u3002\U0001f600 1\u00bd"
    simple = F.regexp_replace(F.lit(marks), f"[^{T.WORD_CHARS}{T.SPACE_CHARS}]+", "")
    assert spark.range(1).select(T.strip_punctuation(F.lit(marks)) == simple).first()[0]
