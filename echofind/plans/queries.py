"""One query per operator over the given tables.

Every query reads whole tables and whole texts. Arrays are written as joined
strings so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from echofind.functions import features as feat
from echofind.functions import hashing, similarity, text
from echofind.operators import diff, evaluate, fingerprint, index, lsh, pairs
from echofind.operators import features as feature_tables
from echofind.plans import pipeline
from echofind.sources import io
from echofind.sources.metrics import read_metrics
from echofind.sources.store import shared_dir, spread, stored

Query = Callable[[SparkSession, str], DataFrame]

NUM_HASHES, SEED, HASH_BITS = 64, 42, 24
NUM_BANDS, ROWS_PER_BAND, RADIUS = 10, 5, 1
PROBE_BANDS, PROBE_ROWS, PROBE_RADIUS = 32, 2, 4
NUM_TABLES, BITS_PER_TABLE, TABLE_RADIUS = 2, 16, 3
SAMPLE_SIZE, VECTOR_BITS = 16, 32
PROBE_WEIGHTS, PROBE_SCORE, PROBE_MINHASH = 0.5, 0.4, 0.02
WEIGHTED_MINHASH, WEIGHTED_SIMHASH, WEIGHTED_SCORE, MINHASH_SCORE = 0.95, 0.05, 0.65, 0.3
OWN_BANDS, OWN_ROWS, OWN_RADIUS = 16, 4, 2
TRUTH_THRESHOLD = 0.6
SAMPLE_PAIRS = 20
EXTRA_STOPWORDS = ("_start_article_",)
STOPWORDS = ("the", "and", "of", "in", "to", "de", "la", "le", "und", "der", "die", "en")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.clean_text("text").alias("text"))


def _probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("probe_id"), "text")
    return items.select("probe_id", text.clean_text("text").alias("text"))


def _joined(tokens: Column | str, separator: str = " ") -> Column:
    """The elements as one string; a missing array is written as an empty string."""
    return F.coalesce(F.array_join(tokens, separator), F.lit(""))


def _grams() -> fingerprint.WordGrams:
    return fingerprint.WordGrams("text", 3)


def _token_grams() -> fingerprint.WordGrams:
    return fingerprint.WordGrams("text", 1, distinct=True)


def _gram_sets(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.select(id_col, feat.ngram_set("text", 3).alias("features"))


def _token_sets(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.select(id_col, feat.token_set("text").alias("features"))


def _minhash(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return fingerprint.minhash_signature(docs, _grams(), NUM_HASHES, SEED, id_col)


def _simhash(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return fingerprint.simhash_signature(_token_sets(docs, id_col), hash_bits=HASH_BITS, id_col=id_col)


def _hybrid(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    grams = fingerprint.WordGrams("text", 3, distinct=True)
    return fingerprint.hybrid_signature(docs, grams, NUM_HASHES, HASH_BITS, SEED, id_col)


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash links of the documents, from stored signatures."""
    return lsh.minhash_candidate_pairs(stored(_minhash(_cleaned(spark, sf_dir))), NUM_BANDS, ROWS_PER_BAND)


def _text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every MinHash candidate pair of distinct texts, each shown by its smallest id: (id1, id2, n1, n2, n_pairs)."""
    options = pipeline.Options()
    groups = stored(pipeline.text_groups(pipeline.compute_signatures(_cleaned(spark, sf_dir), options), options))
    links = stored(pipeline.candidate_links(groups, options))
    return stored(pairs.weigh_pairs(lsh.expand_pairs(links), groups))


def _scored(spark: SparkSession, sf_dir: str) -> pipeline.NearDuplicates:
    return pipeline.find_near_duplicates(_documents(spark, sf_dir))


# --- text ----------------------------------------------------------------------


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).withColumnRenamed("text", "cleaned")


def clean_text_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = text.clean_text_config("text", extra_stopwords=EXTRA_STOPWORDS)
    return _documents(spark, sf_dir).select("doc_id", cleaned.alias("cleaned"))


def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "pages"), "page_id").select("page_id", text.strip_html("html").alias("stripped"))


def normalize_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.normalize_whitespace("text").alias("normalized"))


def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("doc_id", text.remove_stopwords("text", STOPWORDS).alias("kept"))


def pad_short_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", text.pad_short_text(text.clean_text("text")).alias("padded"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = text.tokenize("text", STOPWORDS)
    return _cleaned(spark, sf_dir).select("doc_id", F.size(tokens).alias("n"), _joined(tokens).alias("tokens"))


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = text.ngrams(text.words("text"), 2)
    return _cleaned(spark, sf_dir).select("doc_id", F.size(grams).alias("n"), _joined(grams, "|").alias("ngrams"))


def preprocess_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = text.preprocess("text", n=2, stopwords=STOPWORDS).alias("r")
    return _documents(spark, sf_dir).select("doc_id", record).select(
        "doc_id", "r.cleaned_text", _joined("r.tokens").alias("tokens"), _joined("r.ngrams", "|").alias("ngrams")
    )


# --- features ------------------------------------------------------------------


def _set_rows(sets: DataFrame) -> DataFrame:
    return sets.select(
        "doc_id", F.size("features").alias("n"), _joined(F.sort_array("features"), "|").alias("features")
    )


def ngram_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _set_rows(_gram_sets(_cleaned(spark, sf_dir)))


def token_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _set_rows(_token_sets(_cleaned(spark, sf_dir)))


def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _cleaned(spark, sf_dir).select("doc_id", F.explode(feat.token_frequency("text")).alias("c"))
    return counted.select("doc_id", "c.token", "c.tf")


def tfidf_token_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = feature_tables.tfidf_token_weights(_cleaned(spark, sf_dir))
    return weights.select("token", F.round("weight", 4).alias("weight"))


def idf_token_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = feature_tables.idf_token_weights(_cleaned(spark, sf_dir))
    return weights.select("token", F.round("weight", 6).alias("weight"))


def extract_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _cleaned(spark, sf_dir)
    sizes = [
        feature_tables.extract_features(cleaned, method).select(
            F.lit(method).alias("method"), "doc_id", F.size("features").alias("n")
        )
        for method in ("ngram", "token", "frequency")
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


# --- fingerprints --------------------------------------------------------------


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minhash(_cleaned(spark, sf_dir)).select("doc_id", _joined("signature", ",").alias("signature"))


def minhash_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _text_pairs(spark, sf_dir)
    both = pairs.attach(found, stored(_minhash(pairs.in_pairs(found, _cleaned(spark, sf_dir)))), ["signature"])
    return both.select("id1", "id2", "n_pairs", hashing.minhash_similarity("signature1", "signature2").alias("similarity"))


def _binary(signatures: DataFrame) -> DataFrame:
    return signatures.select("doc_id", hashing.signature_to_binary("signature", HASH_BITS).alias("signature"))


def simhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary(_simhash(_cleaned(spark, sf_dir)))


def simhash_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _cleaned(spark, sf_dir).select("doc_id", feat.token_frequency("text").alias("features"))
    return _binary(fingerprint.simhash_frequency(counts, hash_bits=HASH_BITS))


def simhash_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _cleaned(spark, sf_dir)
    weights = feature_tables.tfidf_token_weights(cleaned)
    return _binary(fingerprint.simhash_weighted(cleaned, weights, _token_grams(), hash_bits=HASH_BITS))


def hamming_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _text_pairs(spark, sf_dir)
    signatures = _hybrid(pairs.in_pairs(found, _cleaned(spark, sf_dir))).select("doc_id", "simhash")
    both = pairs.attach(found, stored(signatures), ["simhash"])
    return both.select("id1", "id2", "n_pairs", hashing.hamming_distance("simhash1", "simhash2").alias("distance"))


def bit_vector_xor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.bit_vector_xor(_token_sets(_cleaned(spark, sf_dir)), hash_bits=VECTOR_BITS)


def bit_vector_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _cleaned(spark, sf_dir)
    weights = feature_tables.idf_token_weights(cleaned)
    return fingerprint.bit_vector_weighted(cleaned, weights, _token_grams(), hash_bits=VECTOR_BITS)


def _sampled(cleaned: DataFrame) -> DataFrame:
    vectors = fingerprint.bit_vector_xor(_token_sets(cleaned), hash_bits=VECTOR_BITS)
    return fingerprint.bit_sample_signature(vectors, SAMPLE_SIZE, VECTOR_BITS, SEED)


def bit_sample_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(_cleaned(spark, sf_dir))


def bit_sample_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _text_pairs(spark, sf_dir)
    both = pairs.attach(found, stored(_sampled(pairs.in_pairs(found, _cleaned(spark, sf_dir)))), ["signature"])
    value = hashing.bit_similarity("signature1", "signature2", SAMPLE_SIZE)
    return both.select("id1", "id2", "n_pairs", value.alias("similarity"))


def hybrid_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hybrid(_cleaned(spark, sf_dir)).select("doc_id", _joined("minhash", ",").alias("minhash"), "simhash")


# --- index ---------------------------------------------------------------------


def minhash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = lsh.minhash_bands(_minhash(_cleaned(spark, sf_dir)), NUM_BANDS, ROWS_PER_BAND)
    return bands.select("doc_id", "band", _joined("key", ",").alias("key"))


def minhash_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.weighted_pairs(stored(_links(spark, sf_dir)))


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts against a stored index of all documents."""
    signatures = _minhash(_cleaned(spark, sf_dir)).withColumnRenamed("signature", "minhash")
    stock = index.StoredIndex.create(signatures, shared_dir(spark), index.IndexSettings(PROBE_BANDS, PROBE_ROWS))
    return stock.query(_minhash(_probes(spark, sf_dir), "probe_id").withColumnRenamed("signature", "minhash"))


def simhash_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.simhash_buckets(_simhash(_cleaned(spark, sf_dir)), RADIUS, HASH_BITS)


def simhash_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = lsh.simhash_candidate_pairs(stored(_simhash(_cleaned(spark, sf_dir))), RADIUS, HASH_BITS)
    return lsh.weighted_pairs(stored(links))


def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = _simhash(_cleaned(spark, sf_dir))
    return lsh.simhash_query(_simhash(_probes(spark, sf_dir), "probe_id"), stock, PROBE_RADIUS, HASH_BITS)


def bitsampling_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.bitsampling_buckets(
        _simhash(_cleaned(spark, sf_dir)), NUM_TABLES, BITS_PER_TABLE, HASH_BITS, SEED
    )


def bitsampling_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    signatures = stored(_simhash(_cleaned(spark, sf_dir)))
    links = lsh.bitsampling_candidate_pairs(signatures, TABLE_RADIUS, NUM_TABLES, BITS_PER_TABLE, HASH_BITS, SEED)
    return lsh.weighted_pairs(stored(links))


def bitsampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = _simhash(_cleaned(spark, sf_dir))
    probes = _simhash(_probes(spark, sf_dir), "probe_id")
    return lsh.bitsampling_query(probes, stock, PROBE_RADIUS, NUM_TABLES, BITS_PER_TABLE, HASH_BITS, SEED)


def _hybrid_merge(strategy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        links = lsh.hybrid_pairs(
            stored(_hybrid(_cleaned(spark, sf_dir))),
            strategy,
            NUM_BANDS,
            ROWS_PER_BAND,
            RADIUS,
            HASH_BITS,
            (WEIGHTED_MINHASH, WEIGHTED_SIMHASH),
            WEIGHTED_SCORE,
            MINHASH_SCORE,
        )
        return lsh.weighted_pairs(stored(links))

    return query


def _twentieth(signatures: DataFrame) -> DataFrame:
    """Every document whose id is divisible by 20 as a probe."""
    return signatures.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "probe_id")


def bitsampling_query_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = stored(_simhash(_cleaned(spark, sf_dir)))
    return lsh.bitsampling_query(_twentieth(stock), stock, TABLE_RADIUS, NUM_TABLES, BITS_PER_TABLE, HASH_BITS, SEED)


def stored_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted probe of ``hybrid_query_weighted`` against an index that is written, appended to and opened again."""
    signatures = stored(_hybrid(_cleaned(spark, sf_dir)))
    path = shared_dir(spark)
    settings = index.IndexSettings(PROBE_BANDS, PROBE_ROWS, PROBE_RADIUS, HASH_BITS)
    older, newer = (signatures.where(f"doc_id % 2 = {k}") for k in (0, 1))
    index.StoredIndex.create(older, path, settings).append(newer)
    weights = (PROBE_WEIGHTS, 1 - PROBE_WEIGHTS)
    return index.StoredIndex.open(spark, path).query(_twentieth(signatures), "weighted", weights, PROBE_SCORE, PROBE_MINHASH)


def _hybrid_probe(strategy: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stock = stored(_hybrid(_cleaned(spark, sf_dir)))
        probes = _twentieth(stock)
        weights = (PROBE_WEIGHTS, 1 - PROBE_WEIGHTS)
        return lsh.hybrid_query(
            probes, stock, strategy, PROBE_BANDS, PROBE_ROWS, PROBE_RADIUS, HASH_BITS, weights, PROBE_SCORE, PROBE_MINHASH
        )

    return query


# --- similarity ----------------------------------------------------------------


def _similarity(measure: pairs.Similarity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = pairs.score_pairs(_text_pairs(spark, sf_dir), _cleaned(spark, sf_dir), measure)
        return scored.select("id1", "id2", "n_pairs", F.round("similarity", 6).alias("similarity"))

    return query


def jaccard_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = similarity.element_names(F.col("features")).alias("names")
    sets = _gram_sets(_cleaned(spark, sf_dir)).select("doc_id", names, F.lit(None).cast("array<bigint>").alias("counts"))
    scored = pairs.score_products(_text_pairs(spark, sf_dir), sets, lambda *p: similarity.jaccard_of_products(*p, empty=1.0))
    return scored.select("id1", "id2", "n_pairs", F.round("similarity", 6).alias("similarity"))


# --- evaluation ----------------------------------------------------------------


def near_duplicate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = _scored(spark, sf_dir).rate()
    return rate.select("candidate_pairs", F.round("near_duplicate_rate", 6).alias("near_duplicate_rate"))


def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).report().select("section", "name", F.round("value", 6).alias("value"))


def _in_groups(spark: SparkSession, sf_dir: str, cleaned: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``cleaned`` whose id is among those of ``groups``.

    Copies are the smaller part as a rule, so their ids are what meets the texts: where Spark finds
    that table small enough, no text is shuffled.
    """
    others = stored(_table(spark, sf_dir, "documents").select("doc_id").join(groups.select("doc_id"), "doc_id", "left_anti"))
    return cleaned.where("doc_id is not null").join(others, "doc_id", "left_anti")


def _collapsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts with features: their groups and their n-gram sets."""
    cleaned = _cleaned(spark, sf_dir)
    options = pipeline.Options()
    groups = stored(pipeline.text_groups(pipeline.compute_signatures(cleaned, options), options))
    return groups, _gram_sets(_in_groups(spark, sf_dir, cleaned, groups))


def exact_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = _cleaned(spark, sf_dir)
    groups = lsh.signature_groups(cleaned.select("doc_id", F.sha2("text", 256).alias("digest")), ("digest",))
    sets = _gram_sets(_in_groups(spark, sf_dir, cleaned, groups))
    found = evaluate.exact_similar_pairs(sets, threshold=TRUTH_THRESHOLD)
    return found.select("id1", "id2", F.round("similarity", 6).alias("similarity"))


def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups, sets = _collapsed(spark, sf_dir)
    truth = evaluate.exact_similar_pairs(sets, threshold=TRUTH_THRESHOLD)
    found = lsh.expand_pairs(stored(pipeline.candidate_links(groups, pipeline.Options())))
    result = evaluate.precision_recall_f1(found, truth, groups)
    ratios = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return result.select("true_positives", "false_positives", "false_negatives", *ratios)


def duplicate_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).distribution()


def sample_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.sample_pairs(lsh.expand_pairs(stored(_links(spark, sf_dir))), SAMPLE_PAIRS, SEED)


def _different_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of distinct texts without the rows that stand for copies."""
    return _text_pairs(spark, sf_dir).where("id1 < id2")


def pair_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_texts(_different_texts(spark, sf_dir), _documents(spark, sf_dir))


def _consecutive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation with the next: pairs of short texts. An id is conv_id * 1000 + turn."""
    turns = spread(_table(spark, sf_dir, "conversations"), "conv_id")
    here = Window.partitionBy("conv_id").orderBy("turn")
    return turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id1"),
        (F.col("conv_id") * 1000 + F.lead("turn").over(here)).alias("id2"),
        F.col("text").alias("text1"),
        F.lead("text").over(here).alias("text2"),
    ).where("id2 is not null")


def _diff_counts(marked: DataFrame) -> DataFrame:
    def count(side: str, op: str) -> Column:
        return F.size(F.filter(side, lambda mark: mark["op"] == op))

    return marked.select(
        "id1",
        "id2",
        count("diff1", "keep").alias("kept"),
        count("diff1", "deleted").alias("deleted"),
        count("diff2", "added").alias("added"),
    )


def pair_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff_counts(diff.pair_diff(_consecutive_turns(spark, sf_dir)))


def pair_diff_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair of distinct documents, word by word."""
    return _diff_counts(diff.pair_diff(pair_texts(spark, sf_dir), deal=False))


def diff_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = diff.pair_diff(_consecutive_turns(spark, sf_dir))
    sides = [
        diff.diff_markup(side, style).alias(f"{style}{side[-1]}") for style in ("html", "latex") for side in ("diff1", "diff2")
    ]
    return marked.select("id1", "id2", *sides)


# --- sources and sinks ---------------------------------------------------------


def read_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.read_corpus(spark, f"{sf_dir}/documents.parquet", id_column="doc_id")


def write_preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/preprocessed.csv"
    io.write_preprocessed(_cleaned(spark, sf_dir), path, id_col="doc_id")
    return io.read_corpus(spark, path, id_column="doc_id")


def write_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/signatures.parquet"
    io.write_signatures(_minhash(_cleaned(spark, sf_dir)), path)
    return spark.read.parquet(path).select("doc_id", _joined("signature", ",").alias("signature"))


def write_signatures_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary strings of the bit signatures, written with their ids and read back."""
    path = f"{shared_dir(spark)}/signatures.csv"
    io.write_signatures(_simhash(_cleaned(spark, sf_dir)), path, hash_bits=HASH_BITS)
    return spark.read.schema("doc_id bigint, text string").option("header", True).csv(path)


def write_signatures_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MinHash signatures with one column per hash, written with their ids and read back."""
    path = f"{shared_dir(spark)}/signatures.csv"
    io.write_signatures(_minhash(_cleaned(spark, sf_dir)), path, num_hashes=NUM_HASHES)
    columns = ", ".join(f"`{i}` bigint" for i in range(NUM_HASHES))
    wide = spark.read.schema(f"doc_id bigint, {columns}").option("header", True).csv(path)
    return wide.select("doc_id", F.concat_ws(",", *[f"`{i}`" for i in range(NUM_HASHES)]).alias("signature"))


def read_corpus_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of two CSV files with their columns in different order and one parquet file."""
    folder = shared_dir(spark)
    docs = _table(spark, sf_dir, "documents")
    parts = {0: ["doc_id", "text"], 1: ["lang", "text", "doc_id"]}
    for k, columns in parts.items():
        docs.where(F.col("doc_id") % 3 == k).select(*columns).write.options(**io.CSV_WRITE).csv(f"{folder}/{k}.csv")
    docs.where("doc_id % 3 = 2").write.parquet(f"{folder}/2.parquet")
    return io.read_corpus(spark, folder, id_column="doc_id")


def read_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/pairs.csv"
    io.write_pairs(_different_texts(spark, sf_dir), path)
    return io.read_pairs(spark, path)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = shared_dir(spark)
    pipeline.run_pipeline(_documents(spark, sf_dir), output)
    return read_metrics(spark, f"{output}/metrics.csv")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)


def runtime_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.runtime_comparison(_run(spark, sf_dir))


# --- end to end ----------------------------------------------------------------


def _end_to_end(options: pipeline.Options | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = pipeline.find_near_duplicates(_documents(spark, sf_dir), options).scored
        return scored.select("id1", "id2", "n_pairs", F.round("similarity", 6).alias("similarity"))

    return query


def inspect_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.inspect_pairs(_documents(spark, sf_dir), _different_texts(spark, sf_dir), SAMPLE_PAIRS, SEED)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        clean_text,
        clean_text_config,
        strip_html,
        normalize_whitespace,
        remove_stopwords,
        pad_short_text,
        tokenize,
        ngrams,
        preprocess_dataset,
        ngram_set,
        token_set,
        token_frequency,
        tfidf_token_weights,
        idf_token_weights,
        extract_features,
        minhash_signature,
        minhash_similarity,
        simhash_signature,
        simhash_frequency,
        simhash_weighted,
        hamming_distance,
        bit_vector_xor,
        bit_vector_weighted,
        bit_sample_signature,
        bit_sample_similarity,
        hybrid_signature,
        minhash_bands,
        minhash_candidate_pairs,
        minhash_query,
        simhash_buckets,
        simhash_candidate_pairs,
        simhash_query,
        bitsampling_buckets,
        bitsampling_candidate_pairs,
        bitsampling_query,
        bitsampling_query_documents,
        stored_index_query,
        jaccard_sets,
        near_duplicate_rate,
        evaluation_report,
        exact_similar_pairs,
        precision_recall_f1,
        duplicate_distribution,
        sample_pairs,
        pair_texts,
        pair_diff,
        pair_diff_documents,
        diff_markup,
        read_corpus,
        read_corpus_directory,
        write_preprocessed,
        write_signatures,
        write_signatures_csv,
        write_signatures_wide,
        read_pairs,
        run_metrics,
        runtime_comparison,
        inspect_pairs,
    )
} | {
    "hybrid_union": _hybrid_merge("union"),
    "hybrid_intersection": _hybrid_merge("intersection"),
    "hybrid_two_stage": _hybrid_merge("two-stage"),
    "hybrid_weighted": _hybrid_merge("weighted"),
    "hybrid_query": _hybrid_probe("union"),
    "hybrid_query_intersection": _hybrid_probe("intersection"),
    "hybrid_query_two_stage": _hybrid_probe("two-stage"),
    "hybrid_query_weighted": _hybrid_probe("weighted"),
    "find_near_duplicates": _end_to_end(None),
    "find_near_duplicates_vectorize": _end_to_end(pipeline.Options(features="vectorize", fingerprint="simhash", hash_bits=HASH_BITS, radius=RADIUS)),
    "find_near_duplicates_bitsampling": _end_to_end(
        pipeline.Options(
            features="token", fingerprint="simhash", index="bitsampling", hash_bits=HASH_BITS, radius=TABLE_RADIUS,
            num_hash_tables=NUM_TABLES, bits_per_table=BITS_PER_TABLE,
        )
    ),
    "find_near_duplicates_cleaning": _end_to_end(
        pipeline.Options(remove_punctuation=False, lowercase=False, stopwords=STOPWORDS, fill_short=True)
    ),
    "find_near_duplicates_hybrid_own": _end_to_end(
        pipeline.Options(fingerprint="hybrid", hybrid_bands=OWN_BANDS, hybrid_rows=OWN_ROWS, hybrid_radius=OWN_RADIUS)
    ),
    "find_near_duplicates_hybrid": _end_to_end(pipeline.Options(fingerprint="hybrid")),
    "cosine_similarity": _similarity(similarity.cosine_similarity),
    "jaccard_text": _similarity(similarity.jaccard_text),
    "euclidean_similarity": _similarity(similarity.euclidean_similarity),
}
