"""The stages of the pipeline and the whole of it on a small corpus, against plain Python."""

import random

import pytest

import corpus_pipeline
from test_duplicates import plain_components

ITEM = "a benchmark question about the height of seven mountains and the names of their rivers"


def rows():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(500)}"
    texts = [None, "", " ", "one", "z" * 50_000]
    for i in range(30):
        base = [word() for _ in range(rng.randrange(8, 90))]
        texts.append(" ".join(base))
        if i % 3 == 0:
            texts += [" ".join(base), " ".join([*base, "tail"])]
        if i % 5 == 0:
            texts.append(" ".join([*base[:4], ITEM.upper(), *base[4:], *(word() for _ in range(60))]))
        if i % 7 == 0:
            texts.append(" ".join([*(word() for _ in range(40)), "password: hunter2hunter2x"]))
    toxic = [" ".join([*(word() for _ in range(20)), *["grunk"] * 3]) for _ in range(40)]
    out = [(10 * i + 7, t, "en", "s", len(t or ""), 1, 2) for i, t in enumerate(texts + toxic)]
    return [*out, out[9]], {r[0] for r in out[len(texts) :]}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs, toxic = rows()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, prediction int, _shard int").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in docs if r[1]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_in_turn(spark, folder):
    docs, toxic = rows()
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    want = [r for r in docs if r[0] not in toxic]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing"]
    for name, rule in (
        ("toxicity", lambda found: found),
        ("ngram_jaccard_join", lambda found: [r for r in found if plain_components([x[:2] for x in found])[r[0]][1] == r[0]]),
        ("benchmark_decontamination", lambda found: [r for r in found if ITEM not in (r[1] or "").lower()]),
        ("secret_scans", lambda found: found),
    ):
        columns = kept.columns
        kept = corpus_pipeline.written(stages[name](spark, kept, folder))
        want = rule(want)
        assert kept.columns == columns
        assert ids(kept) == sorted(r[0] for r in want), name
    found = {r["doc_id"]: r for r in kept.collect()}
    assert not any("hunter2hunter2x" in (r["text"] or "") for r in found.values())
    assert all(r["n_chars"] == len(r["text"] or "") and (r["prediction"], r["_shard"]) == (1, 2) for r in found.values())
    assert all(found[r[0]]["text"] == r[1] for r in want if "password" not in (r[1] or ""))
    packed = stages["packing"](spark, kept, folder)
    assert ids(packed) == ids(kept)
    assert packed.select("bucket", "batch", "slot").distinct().count() == len(want)
    assert ids(corpus_pipeline.run(spark, folder)) == ids(kept)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
