"""Pairs of sets from packed names of their prefixes."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from echofind.operators import evaluate, prefixes
from echofind.plans import queries
from echofind.sources.store import stored

exact = evaluate.exact_similar_pairs


def sets_of(spark, n=120, kind="bigint"):
    """Families around a base, sets alone, one name in all, and an id that two sets share."""
    draw = random.Random(7)
    rows = []
    for i in range(n):
        base = rows[draw.randrange(len(rows))][1] if i > 10 and draw.random() < 0.7 else draw.sample(range(2**62), draw.randint(1, 30))
        kept = [x for x in base if draw.random() < 0.85 and x != 5] or [base[0]]
        rows.append((i, [*kept, *draw.sample(range(2**62), draw.randint(0, 4)), 5]))
    rows.append((3, list(rows[40][1])))
    names = [(f"d{i:03}" if kind == "string" else i, [x - 2**61 for x in r]) for i, r in rows]
    return names, spark.createDataFrame(names, f"doc_id {kind}, names array<bigint>").repartition(3)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("threshold", [0.3, 0.6, 1.0])
def test_no_pair_is_lost(spark, threshold, kind):
    rows, frame = sets_of(spark, kind=kind)
    prefix = stored(prefixes.prefix_rows(stored(frame), threshold, slice_names=50, range_names=40))
    want = {tuple(sorted((a, b))) for (a, x), (b, y) in combinations(rows, 2) if a != b and len({*x} & {*y}) >= threshold * len({*x} | {*y})}
    assert len(want) > 2
    for sizes in ((prefixes.TILE_ROWS, prefixes.MEET_ROWS, prefixes.MEET_PAIRS), (4, 3, 5)):
        found = [tuple(r) for r in prefixes.prefix_pairs(prefix, threshold, *sizes).collect()]
        assert len(found) == len(set(found)) and want <= set(found) and all(a < b for a, b in found)


def test_ranks_are_rarest_first(spark):
    rows, frame = sets_of(spark)
    df = {}
    for _, x in rows:
        for e in x:
            df[e] = df.get(e, 0) + 1
    got = {(r["doc_id"], r["size"], r["name"], r["rank"]) for r in prefixes.prefix_rows(stored(frame), 0.6, 50, 40).collect()}
    want = set()
    for i, x in rows:
        order = sorted(x, key=lambda e: (df[e], e % 2**64))
        last = len(x) + 1 - -(-6 * len(x) // 10)
        want |= {(i, len(x), e, k) for k, e in enumerate(order, 1) if k <= last and df[e] > 1}
    assert got == want


def test_occurrences_leave_packed(spark, monkeypatch):
    """No row of a single occurrence is shuffled to be counted; relatives that share many names make one pair."""
    written = []
    monkeypatch.setattr(evaluate, "stored", lambda df: (written.append(df), stored(df))[1])
    frame = spark.createDataFrame([(i, [f"w{k}" for k in range(40)] + [f"own{i}"]) for i in range(6)], "doc_id bigint, features array<string>")
    found = evaluate.exact_similar_pairs(frame, threshold=0.6)
    assert found.count() == 15
    plan = written[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan and "MapInArrow" in plan
    assert written[1].select("hub").distinct().count() == 1
    assert evaluate.exact_similar_pairs(frame.limit(0), threshold=0.6).count() == 0
    assert evaluate.exact_similar_pairs(frame.select(F.lit(None).cast("bigint").alias("doc_id"), "features"), threshold=0.6).count() == 0


def test_texts_meet_the_ids_of_copies(spark, tmp_path, monkeypatch):
    """Texts stay where they are; of copies the smallest id is kept, rows without id are not."""
    seen = []
    monkeypatch.setattr(queries.evaluate, "exact_similar_pairs", lambda sets, threshold: (seen.append(sets), exact(sets, threshold=threshold))[1])
    words = [f"w{k}" for k in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join([*words, "x"])), (4, None), (None, " ".join(words)), (7, "one two three"), (5, " ".join([*words, "y"])), (6, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("exact_similar_pairs", "precision_recall_f1"):
        found = queries.QUERIES[name](spark, str(tmp_path))
        plan = seen[-1]._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" in plan and "LeftSemi" not in plan
        if name == "exact_similar_pairs":
            assert sorted((r["id1"], r["id2"]) for r in found.collect()) == [(1, 3), (1, 5), (3, 5)]
