"""Toxicity, nearest neighbours, decontamination and the pipeline."""

import math
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from echofind.llm import common, decontaminate, nearest, toxicity


def toxic_corpus(n=1200):
    rng = random.Random(1)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 60))]
        bad = i % 7 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(["grunk", "snarb", f"vexo{rng.choice('abcdefgh')}"])
        rows.append((i, " ".join(words), "l", 1.0))
        if i % 2 == 0 or bad:
            labels.append((i, int(bad)))
    return rows + [(5000, None, "l", 1.0), (5001, "", "l", 1.0)], labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, score double")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1), (7, None), (999_999, 1)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()}
    assert len(got) == len(rows)
    truth = dict(labels)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [i for i in truth if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    assert got[5000]["score"] == got[5001]["score"] and got[5001]["predicted"] == 0


def test_names_of_the_model_are_free(spark):
    rows, labels = toxic_corpus(400)
    names = ("prediction", "probability", "rawPrediction", "_features", "_f_density", "density", "_vector", "Fold")
    docs = spark.createDataFrame([(r[0], r[1], *range(len(names))) for r in [*rows, rows[7], (6000, "grunk " * 300_000, "l", 1.0)]], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model)
    assert got.columns == [*docs.columns, "score", "predicted"]
    found = got.collect()
    assert all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in found)
    assert len({r["score"] for r in found if r["doc_id"] == rows[7][0]}) == 1
    assert [r["predicted"] for r in found if r["doc_id"] == 6000] == [1]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [tuple(r) for r in toxicity.score(docs, model).orderBy("doc_id").collect()] == [(1, "a b", 0.0, 0), (2, None, 0.0, 0)]
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_second_person_and_disguise():
    words = toxicity._Words({"idiot": 3.0, "foul*": 2.0})
    value = dict(zip(toxicity.FEATURES, toxicity.text_features("YOU absolute id1ot! fouler WORDS", words), strict=True))
    assert value["max_odds"] == 3.0 and value["density"] == 2 / 5 and value["near_second_person"] == 2 / 5
    assert value["obfuscated"] == 1 / 5 and value["shouted"] == 2 / 5


def exact(vectors, k=5, every=50):
    good = {i: np.array(v, float) for i, v in vectors if v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in sorted(good):
        if q % every == 0:
            near = [(-float(good[q] @ v / (np.linalg.norm(good[q]) * np.linalg.norm(v))), i) for i, v in good.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.standard_normal(32).tolist()) for i in range(1500)]
    vectors += [(2000 + i, [1.0] * 32) for i in range(40)] + [(3000, None), (3050, [0.0] * 32), (3100, [float("nan")] * 32), (3150, [None] * 32), (3200, [1e300] * 32)]
    df = spark.createDataFrame([(i, v, "s") for i, v in vectors], "vec_id long, embedding array<double>, score string")
    rows = nearest.nearest(df).collect()
    want = exact([v for v in vectors if v[0] != 3200] + [(3200, [1.0] * 32)])
    assert {r["query_id"] for r in rows} == set(want)
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert found >= 0.9 * sum(map(len, want.values()))
    assert [i for i, _ in got[2000]] == [2001, 2002, 2003, 2004, 2005]
    assert all(len(v) == 5 and all(a[1] >= b[1] for a, b in zip(v, v[1:], strict=False)) for v in got.values())


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<double>")
    assert nearest.nearest(df).count() == n * (n - 1)


def plain_distance(pattern, text):
    """Fewest edits between ``pattern`` and any stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, t in enumerate(text, 1):
            row[j] = min(last[j - 1] + (p != t), last[j] + 1, row[j - 1] + 1)
    return min(row)


def test_banded_alignment():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 40)))
        pattern = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
        k = rng.randrange(0, 6)
        found, least = decontaminate.banded(pattern, text, k), plain_distance(pattern, text)
        assert (found is None) == (least > k)
        if found:
            assert found[0] == least and plain_distance(pattern, text[found[1] : found[2]]) == least


def test_band_of_diagonals():
    """A stretch that starts outside the given places is not found; long texts take a band of cells only."""
    text = "y" * 50 + "abcdefghij" + "y" * 50 + "abcdefghiX"
    assert decontaminate.banded("abcdefghij", text, 2, 0, 60) == (0, 50, 60)
    assert decontaminate.banded("abcdefghij", text, 2, 105, 115) == (1, 110, 119)
    assert decontaminate.banded("abcdefghij", text, 2, 0, 40) is None
    rng = random.Random(1)
    item = "".join(rng.choice("abcdefgh ij") for _ in range(27_000))
    edited = "".join(c for c in item if rng.random() > 0.01)
    start = time.perf_counter()
    found = decontaminate.banded(item, "x" * 3000 + edited + "x" * 3000, 1350, 1600, 4400, 250)
    assert found and found[0] <= len(item) - len(edited) and time.perf_counter() - start < 6


def test_short_and_common_benchmark_texts(spark):
    """Texts shorter than a q-gram match on word bounds; a prefix that all items share leads to none of them."""
    short = ["2+2", "What is 2+2", "é!", "one two"]
    lead = "the following question has four answers of which one is right "
    rng = random.Random(5)
    long = [lead + "".join(rng.choice("abcdefghijklm nopq") for _ in range(150)) for _ in range(40)]
    docs = ["so What is  2+2? yes", "12+2", "x 2+2 y 2+2", "é! é!!", "oneone two", "ONE\ntwo", lead * 30, "pre " + long[7] + " post", "a" * 5000, None]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame([*enumerate(short), *((100 + i, t) for i, t in enumerate(long)), (900, "a" * 300)], "item_id long, text string")
    got = {}
    for r in decontaminate.find_leaks(df, benchmark).collect():
        got.setdefault(r["doc_id"], []).append((r["item_id"], r["start"], r["end"], r["edits"]))
    assert sorted(got.pop(8))[0][0] == 900
    assert {i: sorted(v) for i, v in got.items()} == {
        0: [(0, 11, 14, 0), (1, 3, 14, 0)], 2: [(0, 2, 5, 0), (0, 8, 11, 0)], 3: [(2, 0, 2, 0), (2, 3, 5, 0)], 5: [(3, 0, 7, 0)],
        7: [(107, 4, 4 + len(decontaminate.normal(long[7])), 0)],
    }


def test_expansion_by_place_equals_expansion_by_pair(monkeypatch):
    rng = random.Random(2)
    item = "".join(rng.choice("ab") for _ in range(60))
    texts = ["".join(rng.choice("ab") for _ in range(300)) + item for _ in range(5)]
    items = decontaminate.Items([(1, item)], decontaminate.Q, decontaminate.EDIT_RATE)
    want = list(items.search(texts, decontaminate.Q))
    monkeypatch.setattr(decontaminate, "MOST_PAIRS", 1)
    assert want and list(items.search(texts, decontaminate.Q)) == want


def test_leaks(spark):
    rng = random.Random(8)
    letters = "abcdefghij klmn éß"
    items = ["".join(rng.choice(letters) for _ in range(n)) for n in (20, 45, 120, 260)]
    rows, want = [(0, None), (1, ""), (2, items[0][:9])], set()
    for i in range(10, 110):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(2)]
        item = rng.randrange(4)
        body = list(items[item])
        for _ in range(rng.randrange(0, 2 + len(body) // 15)):
            body[rng.randrange(len(body))] = rng.choice(["", "x", "yz"])
        text = parts[0] + " " + "".join(body).upper() + "\n " + parts[1]
        rows.append((i, text))
        for j, pattern in enumerate(items):
            p = decontaminate.normal(pattern)
            if plain_distance(p, decontaminate.normal(text)) <= decontaminate.budget(p)[0]:
                want.add((i, j))
    docs = spark.createDataFrame([(i, t, 0) for i, t in [*rows, rows[5]]], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([*enumerate(items), (9, None), (8, ""), (7, "tiny")], "item_id long, text string")
    got = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert len(want) > 10
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want}
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_texts_are_searched_in_small_slices(monkeypatch):
    """A task lists the q-grams of a few texts at a time, whatever its Arrow batch holds."""
    item = "how high are the seven mountains of the northern island"
    texts = [None, ""] + [f"{'w%d ' % i * 3000}{item if i % 7 == 0 else ''}" for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    items = decontaminate.Items([(1, item)], decontaminate.Q, decontaminate.EDIT_RATE)
    plain, met = decontaminate.Items.search, []

    def search(self, part, q):
        met.append(sum(map(len, part)))
        return plain(self, part, q)

    monkeypatch.setattr(decontaminate.Items, "search", search)
    found = [r for b in decontaminate.in_batches(items, iter([batch]), decontaminate.Q) for r in b.to_pylist()]
    assert [r["doc_id"] for r in found] == [i + 2 for i in range(300) if i % 7 == 0]
    assert len(met) > 5 and max(met) <= 1 << 18


def test_clean_does_not_shuffle_texts_for_a_few_leaks(spark, tmp_path):
    item = "how high are the seven mountains of the northern island"
    rng = random.Random(3)
    rows = [(i, " ".join(str(rng.random()) for _ in range(30)) + (item if i % 500 == 0 else "")) for i in range(2_000)]
    spark.createDataFrame([*rows, rows[500], (None, item)], "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs, benchmark = spark.read.parquet(f"{tmp_path}/docs"), spark.createDataFrame([(1, item)], "item_id long, text string")
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        kept = decontaminate.clean(docs, benchmark)
        plan = kept._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1] + [i for i in range(2_000) if i % 500]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)


def test_a_worker_gives_memory_back_when_its_task_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append("release"))

    def work(batches):
        for b in batches:
            calls.append(b)
            yield b

    assert list(common.lean(work)(iter("ab"))) == ["a", "b"]
    assert calls == ["release", "a", "b", "release"]
