"""The stored index, pairs scored in tiles and the options of a run."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from echofind import Options, find_near_duplicates
from echofind.functions.similarity import cosine_similarity, euclidean_similarity, jaccard_text
from echofind.operators import index, lsh, tiles
from echofind.operators.pairs import score_pairs


def signatures(spark, n=120, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        base = rows[rng.randrange(len(rows))] if i > 20 and rng.random() < 0.6 else None
        minhash = list(base[1]) if base and base[1] else [rng.randrange(1000) for _ in range(12)]
        for _ in range(rng.randrange(0, 4)):
            minhash[rng.randrange(12)] = rng.randrange(1000)
        simhash = (base[2] or 0) ^ (1 << rng.randrange(16)) if base else rng.randrange(1 << 16)
        rows.append((i, None if i % 17 == 0 else minhash, None if i % 23 == 0 else simhash))
    return rows, spark.createDataFrame(rows, "doc_id bigint, minhash array<bigint>, simhash bigint")


def probes_of(df):
    return df.where("doc_id % 4 = 0").withColumnRenamed("doc_id", "probe_id")


@pytest.mark.parametrize("strategy", lsh.MERGE_STRATEGIES)
def test_stored_index_equals_the_probe_joins(spark, tmp_path, strategy):
    _, df = signatures(spark)
    settings = index.IndexSettings(4, 3, 2, 16, buckets=4)
    index.StoredIndex.create(df.where("doc_id < 50"), str(tmp_path / strategy), settings).append(df.where("doc_id >= 50"))
    stock = index.StoredIndex.open(spark, str(tmp_path / strategy))
    assert stock.settings == settings
    scores = ((0.5, 0.5), 0.5, 0.1)
    got = stock.query(probes_of(df), strategy, *scores)
    want = lsh.hybrid_query(probes_of(df), df, strategy, 4, 3, 2, 16, *scores)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 30


def test_an_index_of_another_session_is_opened(spark, tmp_path):
    _, df = signatures(spark)
    first = index.StoredIndex.create(df, str(tmp_path / "i"), index.IndexSettings(4, 3, buckets=4))
    want = sorted(map(tuple, first.query(probes_of(df)).collect()))
    first.drop()  # as a new session, which knows of no table
    again = index.StoredIndex.open(spark, str(tmp_path / "i"))
    assert sorted(map(tuple, again.query(probes_of(df)).collect())) == want
    with pytest.raises(ValueError):
        again.query(probes_of(df), "weighted")


def test_entries_are_not_shuffled(spark, tmp_path):
    _, df = signatures(spark)
    stock = index.StoredIndex.create(df, str(tmp_path / "i"), index.IndexSettings(4, 3, 2, 16, buckets=4))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stock.met(probes_of(df))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_entries_meet_lists_of_probes(spark, tmp_path, monkeypatch):
    """The probes of a name travel as lists of a bounded length, and every pair is met as in the definition."""
    monkeypatch.setattr(index, "MET_PROBES", 3)
    rows, df = signatures(spark)
    stock = index.StoredIndex.create(df, str(tmp_path / "i"), index.IndexSettings(4, 3, 2, 16, buckets=4))
    probes = probes_of(df).unionByName(probes_of(df).where("probe_id = 4"))
    met = stock.met(probes)
    assert met.columns == ["probe_id", "doc_id", "part"] and "collect_list" in met._jdf.queryExecution().optimizedPlan().toString()
    got = met.collect()
    want = []
    for p, m, s in [r for r in rows if r[0] % 4 == 0] + [r for r in rows if r[0] == 4]:
        for d, n, t in rows:
            if m and n:
                want += [(p, d, -1)] * sum(m[3 * k : 3 * k + 3] == n[3 * k : 3 * k + 3] for k in range(4))
            if s is not None and t is not None and (s ^ t).bit_count() <= 2:
                want.append((p, d, next(i for i, mask in enumerate(stock.settings.masks) if not (s ^ t) & mask)))
    assert sorted(map(tuple, got)) == sorted(want)
    assert stock.met(df.limit(0).withColumnRenamed("doc_id", "probe_id")).count() == 0


def test_bands_of_short_signatures_are_an_error(spark, tmp_path):
    short = spark.createDataFrame([(1, [1, 2], 3)], "doc_id bigint, minhash array<bigint>, simhash bigint")
    with pytest.raises(Exception, match="exceeds the signature length"):
        index.StoredIndex.create(short, str(tmp_path / "i"), index.IndexSettings(4, 3, buckets=2))


def test_bands_join_moves_no_array(spark):
    _, df = signatures(spark)
    groups = lsh.signature_groups(df.where("minhash is not null"), ("minhash",))
    plan = lsh._band_pairs(groups, 4, 3, "minhash", 1000)._jdf.queryExecution().optimizedPlan().toString()
    join = plan[: plan.index("posexplode")]
    assert "minhash" not in join
    pairs = lsh._band_pairs(groups, 4, 3, "minhash", 1000)
    assert pairs.count() == pairs.distinct().count() > 0


@pytest.mark.parametrize("tile_pairs", [4000, 7])
@pytest.mark.parametrize("measure", [cosine_similarity, euclidean_similarity, jaccard_text])
def test_tiles_score_as_single_pairs(spark, monkeypatch, measure, tile_pairs):
    monkeypatch.setattr(tiles.in_tiles, "__defaults__", ("doc_id", tile_pairs))
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 30))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    pairs = [(a, b, f"k{a}") for a in range(25) for b in range(a, 25) if rng.random() < 0.4] + [(0, 1, "again"), (0, 1, "again"), (3, 99, "unknown")]
    df = spark.createDataFrame(pairs, "id1 bigint, id2 bigint, kept string")
    got = score_pairs(df, docs, measure)
    assert got.columns == [*df.columns, "similarity"]
    plain = df.join(docs.toDF("id1", "t1"), "id1").join(docs.toDF("id2", "t2"), "id2").select("id1", "id2", "kept", measure("t1", "t2"))
    rounded = lambda rows: sorted((*tuple(r)[:3], round(r[3], 9)) for r in rows)
    assert rounded(got.collect()) == rounded(plain.collect())
    assert score_pairs(df.limit(0), docs, measure).count() == 0


def test_cleaning_options(spark):
    docs = spark.createDataFrame([(1, "The Cat, sat. on  a <b>mat</b> today"), (2, "the cat sat on a mat today"), (3, None), (4, "hi")], "doc_id bigint, text string")
    texts = lambda **o: {r["doc_id"]: r["text"] for r in find_near_duplicates(docs, Options(**o)).cleaned.collect()}
    assert texts()[1] == "the cat sat on a mat today"
    assert texts(lowercase=False)[1] == "The Cat sat on a mat today"
    assert texts(remove_punctuation=False)[1] == "the cat, sat. on a mat today"
    assert texts(stopwords=("the", "a", "on"))[1] == "cat sat mat today"
    assert texts(fill_short=True)[4].startswith("hi") and len(texts(fill_short=True)[4].split()) > 2
    assert set(texts()) == {1, 2, 4}


def test_hybrid_options():
    assert Options().hybrid == (10, 5, 1)
    assert Options(fingerprint="hybrid", hybrid_bands=16, hybrid_rows=4, hybrid_radius=2).hybrid == (16, 4, 2)
    with pytest.raises(ValueError, match="exceeds"):
        Options(fingerprint="hybrid", hybrid_bands=20)
