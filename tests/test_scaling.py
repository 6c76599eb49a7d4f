"""What travels, and how much of it a task holds."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from echofind.functions import text
from echofind.functions.features import ngram_set
from echofind.operators import diff, evaluate, index, lsh, tiles
from echofind.plans.pipeline import find_near_duplicates
from echofind.sources.store import stored


def signatures(spark, n=80):
    draw = random.Random(11)
    rows = [(i, [draw.randint(0, 2) for _ in range(12)], draw.getrandbits(16)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, minhash array<bigint>, simhash bigint")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_probes_do_not_pass_through_the_driver(spark):
    _, df = signatures(spark)
    probes = df.where("doc_id % 4 = 0").withColumnRenamed("doc_id", "probe_id")
    banded = lsh.minhash_query(probes, df, 4, 3, "minhash")
    plan = plan_of(banded)
    assert "Broadcast" not in plan and "SortMergeJoin [_band" in plan
    near = plan_of(lsh.simhash_query(probes, df, 2, 16, "simhash"))
    assert "SortMergeJoin [part" in near


def test_weighted_probe_ships_signatures_by_cell(spark, tmp_path):
    _, df = signatures(spark)
    probes = df.where("doc_id % 4 = 0").withColumnRenamed("doc_id", "probe_id")
    scores = ((0.5, 0.5), 0.5, 0.1)
    found = lsh.hybrid_query(probes, df, "weighted", 4, 3, 2, 16, *scores)
    assert "FlatMapCoGroupsInPandas" in plan_of(found)
    index.StoredIndex.create(df, str(tmp_path / "i"), index.IndexSettings(4, 3, 2, 16, buckets=4))
    same = index.StoredIndex.open(spark, str(tmp_path / "i")).query(probes, "weighted", *scores)
    assert "FlatMapCoGroupsInPandas" in plan_of(same)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, same.collect()))


def test_cells_grow_with_the_pairs(spark):
    """Many pairs make larger cells, so that a document is not shipped once for each few of them."""
    left, right = (spark.range(1000).select(F.col("id").alias(c), F.lit(1).alias("v")) for c in ("probe_id", "doc_id"))
    pairs = left.select("probe_id").crossJoin(right.select("doc_id"))
    got = tiles.in_grid(pairs, left, right, lambda x, y, docs: {"held": np.full(len(x), len(docs))}, ("held",))
    rows, least = got.agg(F.count("*"), F.min("held")).first()
    assert rows == 1_000_000 and least > 450


@pytest.mark.parametrize("cell_pairs, cell_side", [(32_000, 8_000), (5, 3)])
def test_grid_judges_every_pair_with_every_row(spark, cell_pairs, cell_side):
    left = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (3, 30), (9, 90)], "probe_id bigint, v bigint")
    right = spark.createDataFrame([(1, 1), (2, 2), (4, 4), (4, 5)], "doc_id bigint, v bigint")
    pairs = [(a, b) for a in (1, 2, 3, 7) for b in (1, 2, 4, 8)]
    df = spark.createDataFrame(pairs, "probe_id bigint, doc_id bigint")

    def both(x, y, docs: pd.DataFrame):
        v = docs["v"].to_numpy()
        return {"a": v[x], "b": v[y]}

    got = tiles.in_grid(df, left, right, both, ("a", "b"), cell_pairs=cell_pairs, cell_side=cell_side).collect()
    want = [(p, d, a, b) for p, d in pairs for q, a in [(1, 10), (2, 20), (2, 21), (3, 30)] if q == p for e, b in [(1, 1), (2, 2), (4, 4), (4, 5)] if e == d]
    assert sorted(map(tuple, got)) == sorted(want)
    assert tiles.in_grid(df.limit(0), left, right, both, ("a", "b")).count() == 0


def test_tasks_follow_the_pairs(spark):
    df = spark.range(1)
    slots = tiles._tasks(df, 10**6, 1)
    assert tiles._tasks(df, 10**6, 100 * slots * tiles.TASK_PAIRS) == 100 * slots
    assert tiles._tasks(df, 3, 10**9) == 3


def test_a_worker_marks_a_few_words_at_a_time():
    draw = random.Random(2)
    texts = [([draw.choice("abcde") for _ in range(draw.randrange(0, 9))], [draw.choice("abcde") for _ in range(draw.randrange(0, 9))]) for _ in range(60)]
    rows = [{"id1": i, "id2": i + 1, "words1": a, "words2": b} for i, (a, b) in enumerate(texts)]
    batch = pa.RecordBatch.from_pylist(rows)
    pieces = list(diff._diff_batches(iter([batch.slice(3), batch.slice(0, 3), batch.slice(0, 0)]), 20))
    assert len(pieces) > 10
    assert all(p.num_rows == 1 or sum(len(r["diff1"]) + len(r["diff2"]) for r in p.to_pylist()) <= 20 for p in pieces)
    got = [r for p in pieces for r in p.to_pylist()]
    for row, (a, b) in zip(got, texts[3:] + texts[:3], strict=True):
        common = diff.common_words(a, b)
        assert row["diff1"] == diff.mark_words(a, common, "deleted") and row["diff2"] == diff.mark_words(b, common, "added")


@pytest.mark.parametrize("tile_pairs", [250, 3])
def test_texts_are_shuffled_once_for_a_tile(spark, tile_pairs):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(12)] + [(5, "again"), (6, None)], "doc_id bigint, text string")
    pairs = spark.createDataFrame([(a, b) for a in range(12) for b in range(a + 1, 14)], "id1 bigint, id2 bigint")
    texts = tiles.texts_in_tiles(pairs, docs, tile_pairs=tile_pairs)
    want = pairs.join(docs.toDF("id1", "text1"), "id1").join(docs.toDF("id2", "text2"), "id2").select("id1", "id2", "text1", "text2")
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(texts.collect()) == key(want.collect())
    plan = plan_of(diff.pair_diff(texts, deal=False))
    assert "text2" not in plan[plan.index("FlatMapCoGroupsInPandas [") :].split("\n", 1)[1]


def test_texts_are_split_where_they_are_compared(spark):
    """No list of words is made for the worker; its words are those of ``words``."""
    draw = random.Random(8)
    made = lambda: "".join(draw.choice([" ", "  ", "\t", "\n", "\xa0", "\u3000", "\x85", "\x1c", "\u2028", "a", "b", "\u200b"]) for _ in range(draw.randrange(0, 14)))
    rows = [(i, i + 1000, made(), made()) for i in range(150)] + [(1, 2, None, "a"), (1, 3, "a", None)]
    texts = spark.createDataFrame(rows, "id1 bigint, id2 bigint, text1 string, text2 string")
    marked = diff.pair_diff(texts, deal=False)
    assert "split(" not in plan_of(marked)
    sides = [F.transform(f"diff{k}", lambda m: m["word"]).alias(f"w{k}") for k in (1, 2)]
    got = sorted((r["id1"], r["w1"], r["w2"]) for r in marked.select("id1", *sides).collect())
    split = texts.where("text1 is not null and text2 is not null").select("id1", text.words("text1").alias("w1"), text.words("text2").alias("w2"))
    assert got == sorted((r["id1"], r["w1"], r["w2"]) for r in split.collect())


def test_runs_of_white_space(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice([" ", " ", "\t", "\n", " ", "　", "\x85", "\x1c", "a", "b"]) for _ in range(draw.randrange(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = F.trim(F.regexp_replace("text", text.SPACES, " "))
    assert df.where(~text.normalize_whitespace("text").eqNullSafe(plain)).count() == 0


def test_a_distribution_scores_its_pairs_once(spark):
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 7}") for i in range(30)], "doc_id bigint, text string")
    result = find_near_duplicates(docs)
    assert "FlatMapCoGroups" in plan_of(result.scored) and "FlatMapCoGroups" not in plan_of(result.distribution())
    assert {r["n"] for r in result.distribution().where("kind = 'similarity'").collect()}


def test_exact_pairs_build_their_sets_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(evaluate, "stored", lambda df: (written.append(df), stored(df))[1])
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "a b"), (4, None), (5, "a b c d e g")], "doc_id bigint, text string")
    sets = docs.select("doc_id", ngram_set("text", 3).alias("features"))
    found = evaluate.exact_similar_pairs(sets, threshold=0.6)
    assert sorted((r["id1"], r["id2"]) for r in found.collect()) == [(1, 2), (1, 5), (2, 5)]
    assert "Filter" not in written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert dict(written[0].dtypes)["names"] == "array<bigint>"
