"""Sources, sinks, metrics and the end-to-end pipeline."""

from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import oracle
from echofind import Options, find_near_duplicates, inspect_pairs, run_pipeline
from echofind.functions.similarity import jaccard_text
from echofind.operators.lsh import expand_pairs
from echofind.sources import io
from echofind.sources.metrics import RunMetrics, read_metrics
from echofind.sources.store import shared_dir, spread, stored

SAMPLE = [
    (1, "Rain fell on the harbour all night and nobody slept"),
    (2, "Our neighbour repairs clocks in a shed behind the mill"),
    (3, "Three bakers share one oven near the market square"),
    (4, "Sparks table joins are planned before any row is read"),
    (5, "Grey herons wait by the lock until the barges pass"),
    (6, "She sold the last ticket at noon and closed the booth"),
    (7, "The museum keeps its oldest maps in a locked drawer"),
    (8, "The museum keeps its oldest maps in a drawer"),
]
AWKWARD = [(1, 'quote " and, comma'), (2, "two\nlines"), (3, " outer blanks "), (4, "back\\slash"), (5, "ünï"), (6, "")]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, "doc_id bigint, text string").cache()


def pair_set(frame):
    return {(r["id1"], r["id2"]) for r in frame.collect()}


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_corpus_round_trip(spark, tmp_path, kind):
    frame = spark.createDataFrame(AWKWARD, "doc_id bigint, text string")
    path = str(tmp_path / f"corpus.{kind}")
    assert io.write_preprocessed(frame, path, id_col="doc_id") == len(AWKWARD)
    back = io.read_corpus(spark, path, id_column="doc_id")
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == AWKWARD
    numbered = io.read_corpus(spark, path)
    assert numbered.select("doc_id").distinct().count() == len(AWKWARD)


def test_directory_of_both_formats(spark, tmp_path):
    frame = spark.createDataFrame(AWKWARD, "id bigint, text string")
    frame.where("id < 3").write.parquet(str(tmp_path / "tree" / "a" / "part.parquet"))
    frame.where("id >= 3").write.options(**io.CSV_WRITE).csv(str(tmp_path / "tree" / "b" / "deep" / "part.csv"))
    (tmp_path / "tree" / "notes.txt").write_text("ignored")
    back = io.read_corpus(spark, str(tmp_path / "tree"), id_column="id")
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == AWKWARD


def test_read_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        io.read_corpus(spark, str(tmp_path / "missing.parquet"))
    with pytest.raises(FileNotFoundError):
        io.read_pairs(spark, str(tmp_path / "missing.csv"))
    (tmp_path / "file.json").write_text("{}")
    with pytest.raises(ValueError):
        io.read_corpus(spark, str(tmp_path / "file.json"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        io.read_corpus(spark, str(tmp_path / "empty"))
    (tmp_path / "other.csv").write_text("id,body\n1,x\n")
    with pytest.raises(ValueError, match="text"):
        io.read_corpus(spark, str(tmp_path / "other.csv"))
    with pytest.raises(ValueError, match="doc"):
        io.read_corpus(spark, str(tmp_path / "other.csv"), "doc", "body")


def test_corrupt_files_fail_unless_ignored(spark, tmp_path, sample):
    folder = tmp_path / "mixed"
    sample.coalesce(1).write.parquet(str(folder / "good.parquet"))
    (folder / "zz_bad.parquet").write_bytes(b"PAR1 not parquet")
    with pytest.raises(Exception):
        io.read_corpus(spark, str(folder), "doc_id").collect()
    assert io.read_corpus(spark, str(folder), "doc_id", ignore_corrupt_files=True).count() == len(SAMPLE)


def test_write_errors(spark, tmp_path, sample):
    with pytest.raises(ValueError):
        io.write_preprocessed(sample, str(tmp_path / "x.json"))
    with pytest.raises(ValueError):
        io.write_preprocessed(sample.where("doc_id > 99"), str(tmp_path / "none.parquet"))


def test_an_empty_write_keeps_the_old_output(spark, tmp_path, sample):
    for kind in io.FORMATS:
        path = str(tmp_path / f"kept.{kind}")
        io.write_preprocessed(sample, path, id_col="doc_id")
        with pytest.raises(ValueError):
            io.write_preprocessed(sample.where("doc_id > 99"), path, id_col="doc_id")
        assert io.read_corpus(spark, path, "doc_id").count() == len(SAMPLE)
        assert [p.name for p in tmp_path.iterdir() if "kept" in p.name and p.suffix == f".{kind}"] == [f"kept.{kind}"]


def test_directory_of_differing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,alpha one\n")
    (tmp_path / "b.csv").write_text("text,id\nbeta two,2\n")
    (tmp_path / "c.csv").write_text("id,lang,text\n3,en,gamma three\n")
    (tmp_path / "d.csv").write_text("id,text\n4,delta four\n")
    back = io.read_corpus(spark, str(tmp_path), id_column="id")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "alpha one"), (2, "beta two"), (3, "gamma three"), (4, "delta four")]
    (tmp_path / "e.csv").write_text("id,body\n5,x\n")
    with pytest.raises(ValueError, match="text"):
        io.read_corpus(spark, str(tmp_path), id_column="id")


def test_parquet_without_text_is_an_error(spark, tmp_path, sample):
    sample.write.parquet(str(tmp_path / "good"))
    sample.select("doc_id", F.col("text").alias("body")).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="text"):
        io.read_corpus(spark, str(tmp_path), "doc_id")


def test_numbered_rows_keep_their_ids(spark, tmp_path, sample):
    sample.select("text").write.parquet(str(tmp_path / "plain.parquet"))
    corpus = io.read_corpus(spark, str(tmp_path / "plain.parquet"))
    assert sorted(map(tuple, corpus.collect())) == sorted(map(tuple, corpus.repartition(3).collect()))


def test_single_line_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,text\n1,x\n2,y\n")
    back = io.read_corpus(spark, str(tmp_path / "s.csv"), "id", multi_line=False)
    assert sorted(map(tuple, back.collect())) == [(1, "x"), (2, "y")]


def test_pairs_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([(1, 2), (3, 4)], "id1 bigint, id2 bigint")
    path = str(tmp_path / "pairs.csv")
    io.write_pairs(pairs.unionByName(pairs), path)
    assert pair_set(io.read_pairs(spark, path)) == {(1, 2), (3, 4)} and io.read_pairs(spark, path).count() == 2
    (tmp_path / "bad.csv").write_text("1,2,3\n")
    with pytest.raises(Exception):
        io.read_pairs(spark, str(tmp_path / "bad.csv")).collect()
    with pytest.raises(ValueError):
        io.read_pairs(spark, str(tmp_path))


def test_signature_layouts(spark, tmp_path):
    arrays = spark.createDataFrame([(1, [5, 6, 7]), (2, [8, 9, 10])], "doc_id bigint, signature array<bigint>")
    path = str(tmp_path / "s.csv")
    io.write_signatures(arrays, path, num_hashes=3)
    wide = spark.read.option("header", True).csv(path)
    assert wide.columns == ["doc_id", "0", "1", "2"]
    assert sorted(tuple(map(int, r)) for r in wide.collect()) == [(1, 5, 6, 7), (2, 8, 9, 10)]
    for wrong in (2, 4):
        with pytest.raises(Exception, match="num_hashes"):
            io.write_signatures(arrays, path, num_hashes=wrong)
    bits = spark.createDataFrame([(1, 5)], "doc_id bigint, signature bigint")
    io.write_signatures(bits, str(tmp_path / "b.csv"), hash_bits=8)
    assert spark.read.option("header", True).csv(str(tmp_path / "b.csv")).first()["text"] == "00000101"
    io.write_signatures(arrays, str(tmp_path / "s.parquet"))
    assert spark.read.parquet(str(tmp_path / "s.parquet")).schema["signature"].dataType.simpleString() == "array<bigint>"
    for frame in (arrays, bits):
        with pytest.raises(ValueError):
            io.write_signatures(frame, str(tmp_path / "n.csv"))


def test_metrics_round_trip(spark, tmp_path):
    metrics = RunMetrics(params={"num_hashes": 64}, results={"pairs": 3})
    with metrics.stage("index"):
        pass
    metrics.write(spark, str(tmp_path / "m.csv"))
    rows = {(r["section"], r["name"]): r["value"] for r in read_metrics(spark, str(tmp_path / "m.csv")).collect()}
    assert rows["param", "num_hashes"] == "64" and rows["result", "pairs"] == "3"
    assert float(rows["runtime", "index"]) >= 0


def test_store_uses_the_sessions_folder(spark, sample):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(base) and shared_dir(spark) != shared_dir(spark)
    kept = stored(sample)
    assert kept.schema == sample.schema and kept.count() == len(SAMPLE)


def test_spread_leaves_large_scans_alone(spark):
    wide = spark.range(100).repartition(32).withColumnRenamed("id", "doc_id")
    assert spread(wide, "doc_id") is wide
    narrow = spark.range(100).coalesce(1)
    assert spread(narrow, "id").rdd.getNumPartitions() > 8


def test_sample_corpus(sample):
    options = Options(features="ngram", ngram_size=2, num_bands=32, rows_per_band=2)
    result = find_near_duplicates(sample, options)
    assert (7, 8) in pair_set(result.scored)
    assert {r["name"] for r in result.report().collect()} == {"candidate_pairs", "near_duplicate_rate"}


@pytest.mark.parametrize(
    "options",
    [
        Options(),
        Options(features="token", fingerprint="simhash", hash_bits=16, radius=2),
        Options(features="frequency", fingerprint="simhash", index="bitsampling", radius=2),
        Options(features="vectorize", ngram_size=1, fingerprint="simhash", hash_bits=16, radius=2),
        Options(features="token", fingerprint="bitsampling", sample_size=12, bits_per_table=6, radius=2),
        Options(features="vectorize", ngram_size=1, fingerprint="bitsampling", bits_per_table=8),
        Options(fingerprint="hybrid"),
        Options(fingerprint="hybrid", index="simhash"),
        Options(fingerprint="hybrid", merge_strategy="union"),
        Options(features="frequency", fingerprint="minhash"),
    ],
    ids=lambda o: f"{o.features}-{o.fingerprint}-{o.index_method}-{o.merge_strategy}",
)
def test_collapsed_run_equals_run_over_all_documents(spark, documents, options):
    """Texts weighted by their copies give the rate of all document pairs."""
    from echofind.operators.evaluate import near_duplicate_rate
    from echofind.operators.pairs import score_pairs
    from echofind.plans.pipeline import candidate_links, clean_corpus, compute_signatures

    copies = documents.where("doc_id < 6").select((F.col("doc_id") + 10000).alias("doc_id"), "text")
    corpus = documents.unionByName(copies)
    rate = find_near_duplicates(corpus, options).rate().first()
    cleaned = stored(clean_corpus(corpus))
    every = expand_pairs(stored(candidate_links(stored(compute_signatures(cleaned, options)), options)))
    plain = near_duplicate_rate(score_pairs(every, cleaned)).first()
    assert rate["candidate_pairs"] == plain["candidate_pairs"] >= 6
    assert rate["near_duplicate_rate"] == pytest.approx(plain["near_duplicate_rate"])


def test_word_weights_change_signatures(documents):
    from echofind.plans.pipeline import clean_corpus, compute_signatures

    cleaned = stored(clean_corpus(documents))
    for fingerprint, column in (("simhash", "signature"), ("hybrid", "simhash")):
        weighted, plain = (
            {r["doc_id"]: r[column] for r in compute_signatures(cleaned, Options(features=f, fingerprint=fingerprint)).collect()}
            for f in ("vectorize", "token")
        )
        assert weighted.keys() == plain.keys() and weighted != plain


def test_null_and_short_texts(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "two words"), (4, "two words")], "doc_id bigint, text string")
    assert find_near_duplicates(frame).rate().first()["candidate_pairs"] == 0
    counted = find_near_duplicates(frame, Options(features="token", fingerprint="simhash", radius=0)).rate().first()
    assert counted["candidate_pairs"] == 1


def test_single_document(spark):
    frame = spark.createDataFrame([(1, "one single document here")], "doc_id bigint, text string")
    assert tuple(find_near_duplicates(frame).rate().first()) == (0, 0.0)


@pytest.mark.parametrize(
    "bad",
    [
        {"features": "embedding"},
        {"fingerprint": "crc"},
        {"fingerprint": "simhash", "index": "minhash"},
        {"num_bands": 20, "rows_per_band": 5},
    ],
)
def test_option_errors(bad):
    with pytest.raises(ValueError):
        Options(**bad)


def test_run_pipeline_writes_every_stage(spark, documents, tmp_path):
    output = str(tmp_path / "run")
    metrics = run_pipeline(documents, output, similarity=jaccard_text)
    assert set(metrics.runtime) == {"preprocess", "fingerprint", "index", "evaluation"}
    assert metrics.results["raw_data_count"] == documents.count()
    pairs = io.read_pairs(spark, f"{output}/candidate_pairs.csv")
    scored = spark.read.parquet(f"{output}/scored.parquet")
    assert pair_set(pairs) == pair_set(scored.where("id1 < id2")) and pairs.count() == pairs.distinct().count()
    assert scored.agg(F.sum("n_pairs")).first()[0] == metrics.results["candidate_pairs_count"]
    assert 0 < metrics.results["duplicate_rate"] <= 1
    names = {r["name"] for r in read_metrics(spark, f"{output}/metrics.csv").collect()}
    assert {"num_hashes", "duplicate_rate", "index"} <= names


def test_inspect_pairs(spark, sample):
    every = spark.createDataFrame(list(combinations(range(1, 9), 2)), "id1 bigint, id2 bigint")
    shown = inspect_pairs(sample, every, 5).collect()
    assert len(shown) == 5
    pair = spark.createDataFrame([(7, 8)], "id1 bigint, id2 bigint")
    row = inspect_pairs(sample, pair, style="latex").first()
    assert row["markup1"] == "The museum keeps its oldest maps in a \\textcolor{red}{locked} drawer"
    assert row["markup2"] == "The museum keeps its oldest maps in a drawer"


def test_contract_names():
    names = set(contract.QUERIES)
    assert set(oracle.oracle_sql()) <= names <= set(contract.queries())
    assert names - set(oracle.oracle_sql()) == {"pair_diff", "diff_markup", "run_metrics", "runtime_comparison", "inspect_pairs"}


def test_entry(spark):
    assert contract.entry(spark).columns == ["id1", "id2", "n_pairs", "similarity"]
