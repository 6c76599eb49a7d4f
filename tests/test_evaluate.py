"""Similarity, evaluation and diff operators."""

from __future__ import annotations

import math
import random
from functools import cache
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from echofind.functions import features, similarity
from echofind.operators import diff, evaluate, pairs


def cosine(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    if not x or not y:
        return 0.0
    dot = sum(x[w] * y[w] for w in x)
    return dot / (math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values())))


def euclidean(a, b):
    x, y = Counter(a.split()), Counter(b.split())
    return 1 / (1 + math.sqrt(sum((x[w] - y[w]) ** 2 for w in set(x) | set(y))))


def jaccard(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y) if x | y else 0.0


TEXTS = ["", "a", "a a a b", "b c", "a b c d", "d c b a", "x y z", "a b c d e f a b", "   ", "no match here"]


@pytest.mark.parametrize(
    "measure,plain",
    [
        (similarity.cosine_similarity, cosine),
        (similarity.euclidean_similarity, euclidean),
        (similarity.jaccard_text, jaccard),
    ],
)
def test_measures(spark, measure, plain):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    every = spark.createDataFrame(list(combinations(range(len(TEXTS)), 2)), "id1 bigint, id2 bigint")
    scored = pairs.score_pairs(every, docs, measure).collect()
    assert len(scored) == 45
    for row in scored:
        assert row["similarity"] == pytest.approx(plain(TEXTS[row["id1"]], TEXTS[row["id2"]]))
    direct = docs.select("text", measure("text", F.reverse(F.col("text"))).alias("s")).collect()
    assert all(r["s"] == pytest.approx(plain(r["text"], r["text"][::-1])) for r in direct)


def test_any_function_of_two_columns(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "abc")], "doc_id bigint, text string")
    one = spark.createDataFrame([(1, 2)], "id1 bigint, id2 bigint")
    row = pairs.score_pairs(one, docs, lambda a, b: F.levenshtein(a, b).cast("double")).first()
    assert row["similarity"] == 1.0


def test_jaccard_sets(spark):
    rows = [(["oak", "elm", "ash"], ["elm", "ash", "date"]), ([], []), (["a"], [])]
    frame = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert [r[0] for r in frame.select(similarity.jaccard_sets("a", "b")).collect()] == [0.5, 1.0, 0.0]


def test_rate_and_report(spark):
    scored = spark.createDataFrame([(1, 2, 0.5), (1, 3, 1.0)], "id1 bigint, id2 bigint, similarity double")
    assert tuple(evaluate.near_duplicate_rate(scored).first()) == (2, 0.75)
    assert tuple(evaluate.near_duplicate_rate(scored.where("id1 > 9")).first()) == (0, 0.0)
    runtimes = spark.createDataFrame([("index", 1.5)], "stage string, seconds double")
    report = {(r["section"], r["name"]): r["value"] for r in evaluate.evaluation_report(scored, runtimes).collect()}
    assert report == {
        ("result", "candidate_pairs"): 2.0,
        ("result", "near_duplicate_rate"): 0.75,
        ("runtime", "index"): 1.5,
    }


def test_weights_stand_for_all_document_pairs(spark):
    """Texts with copies evaluate like their documents one by one."""
    copies = {1: 3, 2: 1, 3: 2, 4: 1}
    similar = {(1, 2): 0.5, (1, 3): 0.9, (2, 4): 0.71}
    members = {t: [f"{t}.{k}" for k in range(n)] for t, n in copies.items()}
    every = [(a, b, s) for (x, y), s in similar.items() for a in members[x] for b in members[y]]
    every += [(a, b, 1.0) for group in members.values() for a, b in combinations(group, 2)]
    groups = spark.createDataFrame(list(copies.items()), "doc_id bigint, n_copies bigint")
    weighed = pairs.weigh_pairs(spark.createDataFrame(list(similar), "id1 bigint, id2 bigint"), groups)
    table = {**similar} | {(t, t): 1.0 for t in copies}
    scored = weighed.join(
        spark.createDataFrame([(a, b, s) for (a, b), s in table.items()], "id1 bigint, id2 bigint, similarity double"),
        ["id1", "id2"],
    )
    rate = evaluate.near_duplicate_rate(scored).first()
    assert rate["candidate_pairs"] == len(every)
    assert rate["near_duplicate_rate"] == pytest.approx(sum(s for *_, s in every) / len(every))
    partners = Counter(x for a, b, _ in every for x in (a, b))
    actual = {(r["kind"], r["bin"]): r["n"] for r in evaluate.duplicate_distribution(scored).collect()}
    expected = {("similarity", b): n for b, n in Counter(min(int(s * 10 + 1e-9), 9) for *_, s in every).items()}
    expected |= {("pairs_per_document", k): n for k, n in Counter(partners.values()).items()}
    assert actual == expected


def test_distribution_without_weights(spark):
    scored = spark.createDataFrame([(1, 2, 0.7), (1, 3, 1.0)], "id1 bigint, id2 bigint, similarity double")
    rows = {(r["kind"], r["bin"]): r["n"] for r in evaluate.duplicate_distribution(scored).collect()}
    assert rows == {
        ("similarity", 7): 1,
        ("similarity", 9): 1,
        ("pairs_per_document", 2): 1,
        ("pairs_per_document", 1): 2,
    }


def test_sample_pairs(spark):
    frame = spark.createDataFrame([(i, i + 1) for i in range(50)], "id1 bigint, id2 bigint")
    first = {tuple(r) for r in evaluate.sample_pairs(frame, 5, 1).collect()}
    again = {tuple(r) for r in evaluate.sample_pairs(frame.repartition(7), 5, 1).collect()}
    assert first == again and len(first) == 5
    assert first != {tuple(r) for r in evaluate.sample_pairs(frame, 5, 2).collect()}
    assert evaluate.sample_pairs(frame, 500).count() == 50


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.6, 0.8, 1.0])
def test_exact_pairs_equal_brute_force(spark, threshold):
    draw = random.Random(11)
    sets = {i: draw.sample("abcdefghij", draw.randint(0, 8)) for i in range(40)}
    sets |= {i: ["h", "o", "t", f"only{i}"] for i in range(40, 60)}
    frame = spark.createDataFrame(list(sets.items()), "doc_id bigint, features array<string>")
    found = {
        (r["id1"], r["id2"]): r["similarity"]
        for r in evaluate.exact_similar_pairs(frame, threshold=threshold, tile_rows=7).collect()
    }
    expected = {}
    for a, b in combinations(sets, 2):
        union = set(sets[a]) | set(sets[b])
        if sets[a] and sets[b] and len(set(sets[a]) & set(sets[b])) / len(union) >= threshold:
            expected[a, b] = len(set(sets[a]) & set(sets[b])) / len(union)
    assert found == expected


def test_exact_pairs_bounds(spark):
    frame = spark.createDataFrame([(1, ["a"])], "doc_id bigint, features array<string>")
    for threshold in (0.0, 1.5):
        with pytest.raises(ValueError):
            evaluate.exact_similar_pairs(frame, threshold=threshold)


def test_precision_recall(spark):
    found = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "id1 bigint, id2 bigint")
    truth = spark.createDataFrame([(1, 2), (4, 5)], "id1 bigint, id2 bigint")
    row = evaluate.precision_recall_f1(found, truth).first()
    assert tuple(row)[:3] == (1, 2, 1)
    assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((1 / 3, 0.5, 0.4))
    nothing = evaluate.precision_recall_f1(found.where("id1 > 9"), truth.where("id1 > 9")).first()
    assert tuple(nothing) == (0, 0, 0, 0.0, 0.0, 0.0)
    groups = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 3), (5, 1)], "doc_id bigint, n_copies bigint")
    weighted = evaluate.precision_recall_f1(found, truth, groups).first()
    # Pair (1,2) counts twice, copies of 1 and 4 add 1 + 3 true pairs.
    assert tuple(weighted)[:3] == (2 + 1 + 3, 2 + 1, 3)


# --- diff ----------------------------------------------------------------------

word_lists = st.lists(st.sampled_from("abcd"), max_size=14)


def plain_common(a, b):
    """The defining recursion on prefixes: equal last words are common, else the longer of the two shorter problems."""

    @cache
    def longest(i, j):
        if not i or not j:
            return 0, ()
        if a[i - 1] == b[j - 1]:
            n, chain = longest(i - 1, j - 1)
            return n + 1, (chain, a[i - 1])
        # The first of equals wins: dropping a word of ``a`` comes first.
        return max(longest(i - 1, j), longest(i, j - 1), key=lambda found: found[0])

    for i in range(len(a) + 1):  # fills the table row by row, so that no call goes deep
        for j in range(len(b) + 1):
            longest(i, j)
    _, chain = longest(len(a), len(b))
    words = []
    while chain:
        chain, word = chain
        words.append(word)
    return words[::-1]


@settings(max_examples=300, deadline=None)
@given(word_lists, word_lists)
def test_common_words(a, b):
    assert diff.common_words(a, b) == plain_common(a, b)


def test_common_words_of_long_texts():
    draw = random.Random(1)
    a = [str(draw.randint(0, 50)) for _ in range(700)]
    b = [w for w in a if draw.random() > 0.1] + ["end"] * 3
    assert diff.common_words(a, b) == plain_common(a, b)


@settings(max_examples=100, deadline=None)
@given(word_lists, word_lists)
def test_marks_rebuild_both_texts(a, b):
    common = diff.common_words(a, b)
    first, second = diff.mark_words(a, common, "deleted"), diff.mark_words(b, common, "added")
    assert [m["word"] for m in first] == a and [m["word"] for m in second] == b
    assert [m["word"] for m in first if m["op"] == "keep"] == [m["word"] for m in second if m["op"] == "keep"] == common


def test_pair_diff_and_markup(spark):
    texts = spark.createDataFrame(
        [(1, 2, "The drawer holds a very old <map>", "The drawer holds a very <map> indeed"), (3, 4, "", "x")],
        "id1 bigint, id2 bigint, text1 string, text2 string",
    )
    rows = {
        r["id1"]: r
        for r in diff.pair_diff(texts)
        .select(
            "id1",
            diff.diff_markup("diff1", "html").alias("h1"),
            diff.diff_markup("diff2", "html").alias("h2"),
            diff.diff_markup("diff1", "latex").alias("l1"),
            diff.diff_markup("diff2", "latex").alias("l2"),
        )
        .collect()
    }
    assert rows[1]["h1"] == 'The drawer holds a very <span class="deleted">old</span> &lt;map&gt;'
    assert rows[1]["h2"] == 'The drawer holds a very &lt;map&gt; <span class="added">indeed</span>'
    assert rows[1]["l1"] == "The drawer holds a very \\textcolor{red}{old} <map>"
    assert rows[1]["l2"] == "The drawer holds a very <map> \\textcolor{green}{indeed}"
    assert (rows[3]["h1"], rows[3]["h2"]) == ("", '<span class="added">x</span>')
    with pytest.raises(ValueError):
        diff.diff_markup("diff1", "pdf")


def test_count_elements_is_null_safe(spark):
    frame = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,)], "t array<string>")
    rows = [r[0] for r in frame.select(features.count_elements(F.col("t"))).collect()]
    assert [[tuple(c) for c in r] if r is not None else None for r in rows] == [[("a", 1), ("b", 2)], [], None]
