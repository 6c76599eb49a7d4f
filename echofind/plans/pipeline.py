"""From raw texts to near-duplicate pairs and their evaluation."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.functions.features import ngram_set, token_frequency, token_set
from echofind.functions.similarity import Measure, cosine_similarity
from echofind.functions.text import normalize_whitespace, pad_short_text, remove_stopwords, strip_html, strip_punctuation
from echofind.operators import evaluate, fingerprint, lsh
from echofind.operators.classes import score_classes
from echofind.operators.diff import diff_markup, pair_diff
from echofind.operators.features import FEATURE_METHODS, tfidf_token_weights
from echofind.operators.pairs import Similarity, pair_texts, score_pairs, weigh_pairs
from echofind.sources.io import write_pairs, write_preprocessed, write_signatures
from echofind.sources.metrics import RunMetrics
from echofind.sources.store import spread, stored

FINGERPRINTS = ("minhash", "simhash", "bitsampling", "hybrid")
# Which indexes can hold which fingerprints.
INDEXES = {
    "minhash": ("minhash",),
    "simhash": ("simhash", "bitsampling"),
    "bitsampling": ("bitsampling", "simhash"),
    "hybrid": ("hybrid", "minhash", "simhash", "bitsampling"),
}


@dataclass(frozen=True)
class Options:
    """Settings of a run. ``index`` defaults to the index named like the fingerprint.

    A hybrid index has bands and a radius of its own where ``hybrid_bands``, ``hybrid_rows``
    or ``hybrid_radius`` say so, else those of the others.
    """

    remove_punctuation: bool = True
    lowercase: bool = True
    stopwords: tuple[str, ...] = ()
    fill_short: bool = False
    features: str = "ngram"
    ngram_size: int = 3
    fingerprint: str = "minhash"
    num_hashes: int = 64
    hash_bits: int = 24
    sample_size: int = 16
    seed: int = 42
    hash_method: str = "md5"
    index: str | None = None
    num_bands: int = 10
    rows_per_band: int = 5
    radius: int = 1
    num_hash_tables: int = 2
    bits_per_table: int = 16
    merge_strategy: str = "weighted"
    weights: tuple[float, float] = (0.95, 0.05)
    weighted_score_threshold: float = 0.65
    minhash_score_threshold: float = 0.3
    hybrid_bands: int | None = None
    hybrid_rows: int | None = None
    hybrid_radius: int | None = None

    def __post_init__(self) -> None:
        if self.features not in FEATURE_METHODS:
            raise ValueError(f"features are one of {FEATURE_METHODS}, not {self.features!r}")
        if self.fingerprint not in FINGERPRINTS:
            raise ValueError(f"Unknown fingerprint method: {self.fingerprint}; use one of {FINGERPRINTS}")
        if self.index_method not in INDEXES[self.fingerprint]:
            raise ValueError(f"Index {self.index_method!r} cannot hold {self.fingerprint} fingerprints")
        bands, rows, _ = self.hybrid if self.index_method == "hybrid" else (self.num_bands, self.rows_per_band, 0)
        if self.index_method in ("minhash", "hybrid") and bands * rows > self.num_hashes:
            raise ValueError("num_bands * rows_per_band exceeds num_hashes")

    @property
    def index_method(self) -> str:
        return self.index or self.fingerprint

    @property
    def hybrid(self) -> tuple[int, int, int]:
        """Bands, rows and radius of a hybrid index."""
        own = (self.hybrid_bands, self.hybrid_rows, self.hybrid_radius)
        shared = (self.num_bands, self.rows_per_band, self.radius)
        return tuple(b if a is None else a for a, b in zip(own, shared, strict=True))

    @property
    def signature_bits(self) -> int:
        """Width of a bit signature."""
        return self.sample_size if self.fingerprint == "bitsampling" else self.hash_bits

    @property
    def needs_minhash(self) -> bool:
        """Whether a document without MinHash signature can be no candidate."""
        if self.index_method == "hybrid":
            return self.merge_strategy != "union"
        return self.index_method == "minhash"

    @property
    def signature_columns(self) -> tuple[str, ...]:
        return ("minhash", "simhash") if self.fingerprint == "hybrid" else ("signature",)


@dataclass(frozen=True)
class NearDuplicates:
    """Tables of a run.

    ``cleaned``  ``(doc_id, text)``
    ``signatures``  one row per document with ``digest`` of the cleaned text
    ``groups``  one row per distinct text: smallest id, ``n_copies``, signature
    ``links``  candidate links between distinct texts
    ``scored``  candidate pairs of distinct texts with weights and similarity
    """

    cleaned: DataFrame
    signatures: DataFrame
    groups: DataFrame
    links: DataFrame
    scored: DataFrame

    def rate(self) -> DataFrame:
        return evaluate.near_duplicate_rate(self.scored)

    def report(self, runtimes: DataFrame | None = None) -> DataFrame:
        return evaluate.evaluation_report(self.scored, runtimes)

    def distribution(self) -> DataFrame:
        # Read for the histogram and for the partners: stored, so that pairs are scored once.
        return evaluate.duplicate_distribution(stored(self.scored))


def cleaned_text(options: Options) -> Column:
    """The text as the options clean it: tags and runs of white space always go."""
    cleaned = normalize_whitespace(strip_html("text"))
    if options.remove_punctuation:
        cleaned = strip_punctuation(cleaned)
    if options.lowercase:
        cleaned = F.lower(cleaned)
    if options.stopwords:
        cleaned = remove_stopwords(cleaned, options.stopwords)
    return pad_short_text(cleaned) if options.fill_short else cleaned


def clean_corpus(corpus: DataFrame, options: Options | None = None) -> DataFrame:
    """Cleaned texts; documents without text have no features and are left out."""
    return corpus.where("text is not null").select("doc_id", cleaned_text(options or Options()).alias("text"))


def compute_signatures(cleaned: DataFrame, options: Options) -> DataFrame:
    """``(doc_id, digest, signature columns)`` of every document.

    The digest of the cleaned text travels with the signature, so exact
    copies are grouped without shuffling any text.
    """
    docs = cleaned.withColumn("digest", F.sha2("text", 256))
    shared = {"keep": ("digest",), "hash_method": options.hash_method}
    # The weights of ``vectorize`` belong to single words, so words are its features.
    by_word = options.features in ("token", "frequency", "vectorize")
    sets = token_set("text") if by_word else ngram_set("text", options.ngram_size)
    if options.fingerprint == "minhash":
        # A minimum ignores repeats, so the lists need no deduplication.
        listed = fingerprint.WordGrams("text", 1 if by_word else options.ngram_size)
        return fingerprint.minhash_signature(docs, listed, options.num_hashes, options.seed, **shared)
    by_vector = fingerprint.WordGrams("text", 1, distinct=True)
    if options.fingerprint == "hybrid" and options.features == "vectorize":
        weighted = fingerprint.simhash_weighted(
            docs, tfidf_token_weights(cleaned), by_vector, options.hash_bits, hash_method=options.hash_method
        )
        minima = fingerprint.minhash_signature(
            docs, fingerprint.WordGrams("text", 1), options.num_hashes, options.seed, **shared
        )
        return minima.withColumnRenamed("signature", "minhash").join(
            weighted.select("doc_id", F.col("signature").alias("simhash")), "doc_id"
        )
    if options.fingerprint == "hybrid":
        grams = fingerprint.WordGrams("text", 1 if by_word else options.ngram_size, distinct=True)
        return fingerprint.hybrid_signature(
            docs, grams, options.num_hashes, options.hash_bits, options.seed, **shared
        )
    if options.fingerprint == "simhash":
        if options.features == "frequency":
            return fingerprint.simhash_frequency(docs, token_frequency("text"), options.hash_bits, **shared)
        if options.features == "vectorize":
            weights = tfidf_token_weights(cleaned)
            return fingerprint.simhash_weighted(docs, weights, by_vector, options.hash_bits, **shared)
        return fingerprint.simhash_signature(docs, sets, options.hash_bits, **shared)
    if options.features == "vectorize":
        weights = tfidf_token_weights(cleaned)
        vectors = fingerprint.bit_vector_weighted(docs, weights, by_vector, options.hash_bits, **shared)
    else:
        vectors = fingerprint.bit_vector_xor(docs, sets, options.hash_bits, **shared)
    return fingerprint.bit_sample_signature(vectors, options.sample_size, options.hash_bits, options.seed)


def text_groups(signatures: DataFrame, options: Options) -> DataFrame:
    """One row per distinct cleaned text that can be a candidate.

    The counts combine before the shuffle.
    """
    present = signatures
    if options.needs_minhash:
        present = signatures.where(F.col(options.signature_columns[0]).isNotNull())
    return lsh.signature_groups(present, ("digest", *options.signature_columns))


def candidate_links(signatures: DataFrame, options: Options, buckets: bool = False) -> DataFrame:
    """Link table of any signature table ``(doc_id, signature columns)``.

    With ``buckets`` the links of an index of bit signatures also say in which ``bucket`` they are met.
    """
    method = options.index_method
    if method == "hybrid":
        return lsh.hybrid_pairs(
            signatures,
            options.merge_strategy,
            *options.hybrid,
            options.hash_bits,
            options.weights,
            options.weighted_score_threshold,
            options.minhash_score_threshold,
        )
    hybrid = options.fingerprint == "hybrid"
    if method == "minhash":
        return lsh.minhash_candidate_pairs(
            signatures,
            options.num_bands,
            options.rows_per_band,
            "minhash" if hybrid else "signature",
        )
    column = "simhash" if hybrid else "signature"
    if method == "simhash":
        return lsh.simhash_candidate_pairs(signatures, options.radius, options.signature_bits, column, buckets=buckets)
    return lsh.bitsampling_candidate_pairs(
        signatures,
        options.radius,
        options.num_hash_tables,
        options.bits_per_table,
        options.signature_bits,
        options.seed,
        column,
        buckets=buckets,
    )


def score_links(
    links: DataFrame, groups: DataFrame, cleaned: DataFrame, similarity: Similarity = cosine_similarity
) -> DataFrame:
    """Every candidate pair of distinct texts, weighted by copies and scored.

    ``links`` and ``groups`` are read several times: store them first. For a ``Measure`` the pairs come
    into being where they are scored; they are written out first for any other function, for links of
    several relations and for ids that several texts share.
    """
    if isinstance(similarity, Measure) and similarity.named is not None:
        repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
        if repeated.isEmpty() and links.select("source").distinct().count() <= 1:

            def named(ids: DataFrame) -> DataFrame:
                needed = cleaned.join(ids, "doc_id", "left_semi")
                return needed.select("doc_id", similarity.named("text").alias("_n")).select("doc_id", "_n.names", "_n.counts")

            return score_classes(links, groups, named, similarity.of_products)
    return score_pairs(weigh_pairs(lsh.expand_pairs(links), groups), cleaned, similarity)


def find_near_duplicates(
    corpus: DataFrame,
    options: Options | None = None,
    similarity: Similarity = cosine_similarity,
) -> NearDuplicates:
    """The whole pipeline over ``(doc_id, text)``.

    Signatures and groups are stored before the index and the scores read
    them; texts stay where they are and are joined only to the pairs found.
    """
    options = options or Options()
    cleaned = clean_corpus(corpus, options)
    signatures = stored(compute_signatures(cleaned, options))
    groups = stored(text_groups(signatures, options))
    links = stored(candidate_links(groups, options, buckets=True))
    return NearDuplicates(cleaned, signatures, groups, links.drop("bucket"), score_links(links, groups, cleaned, similarity))


def run_pipeline(
    corpus: DataFrame,
    output: str,
    options: Options | None = None,
    similarity: Similarity = cosine_similarity,
) -> RunMetrics:
    """Run stage by stage, each stage reading the tables the one before wrote.

    Below ``output``: ``preprocessed.parquet``, ``signatures.parquet``,
    ``links.parquet``, ``scored.parquet``, ``candidate_pairs.csv``,
    ``report.csv``, ``distribution.csv`` and ``metrics.csv``. The written
    tables cut the lineage, so a lost executor never reruns an earlier stage.
    ``candidate_pairs.csv`` has the candidate pairs of distinct texts, each shown by
    its smallest id, and ``groups.parquet`` says how many copies each text has.
    """
    options = options or Options()
    spark = corpus.sparkSession
    metrics = RunMetrics(params=asdict(options))

    def saved(name: str) -> DataFrame:
        return spark.read.parquet(f"{output}/{name}.parquet")

    with metrics.stage("preprocess"):
        rows = write_preprocessed(clean_corpus(corpus, options), f"{output}/preprocessed.parquet", id_col="doc_id")
        metrics.results["raw_data_count"] = rows
    cleaned = saved("preprocessed")
    with metrics.stage("fingerprint"):
        rows = write_signatures(
            compute_signatures(spread(cleaned, "doc_id"), options), f"{output}/signatures.parquet"
        )
        metrics.results["signature_count"] = rows
    with metrics.stage("index"):
        groups = text_groups(saved("signatures"), options)
        groups.write.mode("overwrite").parquet(f"{output}/groups.parquet")
        groups = saved("groups")
        candidate_links(groups, options).write.mode("overwrite").parquet(f"{output}/links.parquet")
        write_pairs(lsh.expand_pairs(saved("links")), f"{output}/candidate_pairs.csv")
    with metrics.stage("evaluation"):
        score_links(saved("links"), groups, cleaned, similarity).write.mode("overwrite").parquet(
            f"{output}/scored.parquet"
        )
        scored = saved("scored")
        rate = evaluate.near_duplicate_rate(scored).first()
        metrics.results["candidate_pairs_count"] = rate["candidate_pairs"]
        metrics.results["duplicate_rate"] = rate["near_duplicate_rate"]
        evaluate.duplicate_distribution(scored).write.mode("overwrite").csv(f"{output}/distribution.csv", header=True)
    runtimes = evaluate.runtime_comparison(metrics.table(spark))
    evaluate.evaluation_report(scored, runtimes).write.mode("overwrite").csv(f"{output}/report.csv", header=True)
    metrics.write(spark, f"{output}/metrics.csv")
    return metrics


def inspect_pairs(corpus: DataFrame, pairs: DataFrame, n: int = 10, seed: int = 42, style: str = "html") -> DataFrame:
    """Sampled pairs with both raw texts marked up word by word."""
    chosen = evaluate.sample_pairs(pairs, n, seed)
    marked = pair_diff(pair_texts(chosen, corpus))
    return marked.select(
        "id1", "id2", diff_markup("diff1", style).alias("markup1"), diff_markup("diff2", style).alias("markup2")
    )
