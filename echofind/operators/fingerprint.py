"""Document fingerprints: MinHash, SimHash, XOR and sampled bit vectors.

Each operator explodes a feature array and aggregates it by document. The
features of one document leave the scan together, so the partial aggregation
shrinks them to one row before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from echofind.functions.batches import batch_words
from echofind.functions.hashing import (
    MAX_HASH_BITS,
    MINHASH_PRIME,
    assemble_bits,
    bit,
    bit_sample,
    check_hash_bits,
    feature_hash,
    md5_words,
    minhash_params,
    sample_bit_indices,
)
from echofind.functions.text import as_column, ngrams, words
from echofind.operators.dictionary import flat, in_blocks, sums
from echofind.sources.store import stored

WEIGHT_UNIT = 1_000_000
#: Hashes that are worked on at once, few enough for the cache, and documents of a result batch.
HASH_PIECE, HASH_ROWS = 16_384, 512
#: Documents whose distinct words are hashed together.
WORD_ROWS = 2_048


@dataclass(frozen=True)
class WordGrams:
    """The word n-grams of a text column, for operators that form them where they hash them.

    ``column`` has the same n-grams as an array; ``distinct`` drops repeats.
    """

    text: str = "text"
    n: int = 3
    distinct: bool = False

    def column(self) -> Column:
        grams = ngrams(words(self.text), self.n)
        return F.array_distinct(grams) if self.distinct else grams

    def spans(self, text: bytes | None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words joined by single spaces, and where in that each n-gram begins and ends."""
        # Python and ``SPACE_CHARS`` have the same white space.
        joined = " ".join((text or b"").decode("utf-8", "replace").split()).encode()
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        if not joined or len(gaps) + 1 < self.n:
            return b"", gaps[:0], gaps[:0]
        starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
        return joined, starts[: len(ends) - self.n + 1], ends[self.n - 1 :]


def _exploded(docs: DataFrame, features: Column | str | WordGrams, keys: list[str]) -> DataFrame:
    listed = features.column() if isinstance(features, WordGrams) else as_column(features)
    return docs.select(*keys, F.explode_outer(listed).alias("feature"))


def _minima(hashed: np.ndarray, starts: np.ndarray, params: list[tuple[int, int]]) -> np.ndarray:
    """The minimum of each hash function over the runs that begin at ``starts``: one row for each run."""
    prime, bits = np.uint64(MINHASH_PRIME), np.uint64(31)
    result = np.empty((len(starts), len(params)), np.int64)
    value, high = np.empty_like(hashed), np.empty_like(hashed)
    for i, (a, b) in enumerate(params):
        np.multiply(hashed, np.uint64(a), out=value)
        np.add(value, np.uint64(b), out=value)
        # 2^31 is 1 modulo the prime, so the high bits are added to the low ones; what is left is below twice the
        # prime, and where it is below the prime the subtraction wraps to a large value.
        np.right_shift(value, bits, out=high)
        np.bitwise_and(value, prime, out=value)
        np.add(value, high, out=value)
        np.subtract(value, prime, out=high)
        np.minimum(value, high, out=value)
        result[:, i] = np.minimum.reduceat(value, starts)
    return result


def _gram_votes(hashed: np.ndarray, starts: np.ndarray, hash_bits: int) -> np.ndarray:
    """Number of hashes, and of those with bit i set, in the runs that begin at ``starts``."""
    result = np.empty((len(starts), 1 + hash_bits), np.int64)
    result[:, 0] = np.diff(np.append(starts, len(hashed)))
    for i in range(hash_bits):
        result[:, 1 + i] = np.add.reduceat(hashed >> np.uint64(i) & np.uint64(1), starts).view(np.int64)
    return result


def _list_column(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists, null where a row is not ``present``."""
    edge = np.concatenate([[0], np.cumsum(present * rows.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(rows[present].ravel()), mask=pa.array(~present))


def _gram_partials(
    docs: DataFrame, grams: WordGrams, keys: list[str], num_hashes: int, seed: int | None, hash_bits: int = 0
) -> DataFrame:
    """Partial results of MD5 hashes: the keys, ``_m`` minima and, with ``hash_bits``, ``_v`` votes.

    Each document gives one row, of nulls where it has no n-grams.
    """
    params = minhash_params(num_hashes, seed)
    widths = [num_hashes, *([1 + hash_bits] if hash_bits else [])]

    def hashed(texts: list[bytes | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Some documents, their hashes (both words as one number) and where those of each begin."""
        owners, data, begins, sizes, length, held = [], [], [], [], 0, 0
        for row, text in enumerate(texts):
            joined, starts, ends = grams.spans(text)
            if len(starts):
                owners.append(row)
                data.append(joined)
                begins.append(starts + length)
                sizes.append(ends - starts)
                length, held = length + len(joined), held + len(starts)
            if held and (held >= HASH_PIECE or row == len(texts) - 1):
                edge = np.cumsum([0, *map(len, begins)])
                value = md5_words(b"".join(data), np.concatenate(begins), np.concatenate(sizes), HASH_PIECE)
                if grams.distinct:
                    # N-grams of a document with the same 64 bits are taken for one.
                    run = np.repeat(np.arange(len(owners)), np.diff(edge))
                    order = np.lexsort((value, run))
                    value, run = value[order], run[order]
                    first = np.append(True, (value[1:] != value[:-1]) | (run[1:] != run[:-1]))
                    value, edge = value[first], np.searchsorted(run[first], np.arange(len(owners) + 1))
                yield owners, value, edge[:-1]
                owners, data, begins, sizes, length, held = [], [], [], [], 0, 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, HASH_ROWS):
                batch = whole.slice(first, HASH_ROWS)
                results = [np.zeros((batch.num_rows, w), np.int64) for w in widths]
                present = np.zeros(batch.num_rows, bool)
                for owners, value, starts in hashed(batch.column(len(keys)).cast(pa.binary()).to_pylist()):
                    present[owners] = True
                    results[0][owners] = _minima((value & np.uint64(2**32 - 1)) % np.uint64(MINHASH_PRIME), starts, params)
                    if hash_bits:
                        results[1][owners] = _gram_votes(value, starts, hash_bits)
                lists = [_list_column(r, present) for r in results]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *lists], [*keys, *("_m", "_v")[: len(widths)]])

    read = docs.select(*keys, F.col(grams.text).alias("_text"))
    added = [StructField(c, ArrayType(LongType())) for c in ("_m", "_v")[: len(widths)]]
    return read.mapInArrow(work, StructType([*read.schema.fields[:-1], *added]))


def _word_names(docs: DataFrame, grams: WordGrams, keys: list[str]) -> DataFrame:
    """The keys and ``names array<bigint>``: 64 bits of MD5 of each word. A batch hashes each of its words once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, WORD_ROWS):
                batch = whole.slice(first, WORD_ROWS)
                texts = batch.column(len(keys)).cast(pa.binary()).to_pylist()
                found = batch_words(pa.array([" ".join((t or b"").decode("utf-8", "replace").split()) for t in texts], pa.string()))
                values = found.names()[found.code]
                if grams.distinct:
                    names = found.lists(values)
                else:
                    edge = np.concatenate([[0], np.cumsum(found.count)])[found.edge]
                    names = replace(found, edge=edge).lists(np.repeat(values, found.count))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], names], [*keys, "names"])

    read = docs.select(*keys, F.col(grams.text).alias("_text"))
    return read.mapInArrow(work, StructType([*read.schema.fields[:-1], StructField("names", ArrayType(LongType()))]))


def _folded(partials: DataFrame, keys: list[str], num_hashes: int, hash_bits: int = 0) -> DataFrame:
    """Minima and votes of each document from its partial results."""
    minima = [F.min(F.get("_m", F.lit(i))).alias(f"m{i}") for i in range(num_hashes)]
    names = ["total", *(f"v{i}" for i in range(hash_bits))] if hash_bits else []
    return partials.groupBy(*keys).agg(*minima, *[F.sum(F.get("_v", F.lit(i))).alias(c) for i, c in enumerate(names)])


def _keys(id_col: str, keep: tuple[str, ...]) -> list[str]:
    return [id_col, *keep]


def _minhash_minima(num_hashes: int, seed: int | None) -> list[Column]:
    """One minimum per hash function over the base hash ``h``."""
    return [
        F.min((F.col("h") * F.lit(a).cast("bigint") + F.lit(b).cast("bigint")) % F.lit(MINHASH_PRIME).cast("bigint")).alias(f"m{i}")
        for i, (a, b) in enumerate(minhash_params(num_hashes, seed))
    ]


def _minhash_array(num_hashes: int) -> Column:
    """The signature array; null for a document without features."""
    return F.when(F.col("m0").isNotNull(), F.array(*[F.col(f"m{i}") for i in range(num_hashes)]))


def _votes(weight: Column, hashed: Column, hash_bits: int) -> list[Column]:
    """Total weight, and the weight of the features that have bit i set."""
    return [F.sum(weight).alias("total")] + [
        F.sum(bit(hashed, i) * weight).alias(f"v{i}") for i in range(hash_bits)
    ]


def _majority(hash_bits: int) -> Column:
    """Bit i is set where the set weight exceeds the unset weight."""
    two = F.lit(2).cast("bigint")
    return assemble_bits([F.coalesce(F.col(f"v{i}") * two > F.col("total"), F.lit(False)) for i in range(hash_bits)])


def minhash_signature(
    docs: DataFrame,
    features: Column | str | WordGrams = "features",
    num_hashes: int = 64,
    seed: int | None = 42,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """``(id, signature array<bigint>)``; null signature without features.

    A minimum ignores repeats, so ``features`` may be a list as well as a set.
    ``keep`` names further columns that depend on the id alone. ``WordGrams`` with ``md5`` are
    hashed in Arrow batches of texts, anything else is exploded.
    """
    keys = _keys(id_col, keep)
    if isinstance(features, WordGrams) and hash_method == "md5":
        folded = _folded(_gram_partials(docs, features, keys, num_hashes, seed), keys, num_hashes)
        return folded.select(*keys, _minhash_array(num_hashes).alias("signature"))
    base = feature_hash("feature", 32, hash_method) % F.lit(MINHASH_PRIME).cast("bigint")
    hashed = _exploded(docs, features, keys).select(*keys, base.alias("h"))
    return (
        hashed.groupBy(*keys)
        .agg(*_minhash_minima(num_hashes, seed))
        .select(*keys, _minhash_array(num_hashes).alias("signature"))
    )


def simhash_signature(
    docs: DataFrame,
    features: Column | str = "features",
    hash_bits: int = 24,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """``(id, signature bigint)`` from a feature set, every feature with weight 1."""
    keys = _keys(id_col, keep)
    hashed = _exploded(docs, features, keys).select(
        *keys, feature_hash("feature", hash_bits, hash_method).alias("h")
    )
    one = F.when(F.col("h").isNotNull(), F.lit(1).cast("bigint"))
    return (
        hashed.groupBy(*keys)
        .agg(*_votes(one, F.col("h"), hash_bits))
        .select(*keys, _majority(hash_bits).alias("signature"))
    )


def simhash_frequency(
    docs: DataFrame,
    frequencies: Column | str = "features",
    hash_bits: int = 24,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """SimHash of ``array<struct<token,tf>>`` where a token votes with its count."""
    keys = _keys(id_col, keep)
    hashed = _exploded(docs, frequencies, keys).select(
        *keys,
        feature_hash("feature.token", hash_bits, hash_method).alias("h"),
        F.col("feature.tf").alias("tf"),
    )
    return (
        hashed.groupBy(*keys)
        .agg(*_votes(F.col("tf"), F.col("h"), hash_bits))
        .select(*keys, _majority(hash_bits).alias("signature"))
    )


def simhash_weighted(
    docs: DataFrame,
    weights: DataFrame,
    features: Column | str | WordGrams = "features",
    hash_bits: int = 24,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """SimHash with weights from a table ``(token, weight)``, one row for each token; a missing token weighs 1.

    Weights are scaled to whole micro-units so that a sum does not depend on
    its order. Features travel as one array of 64-bit hashes with each document, and only the
    distinct ones of a block of documents meet the weights; the low bits vote. Null features
    do not vote. The hashes are stored first. Words by ``WordGrams`` with ``md5`` are hashed in Arrow batches of texts.
    """
    check_hash_bits(hash_bits)
    keys = _keys(id_col, keep)
    if isinstance(features, WordGrams) and features.n == 1 and hash_method == "md5":
        hashed = stored(_word_names(docs, features, keys))
    else:
        listed = features.column() if isinstance(features, WordGrams) else as_column(features)
        present = docs.select(*keys, F.filter(listed, lambda f: f.isNotNull()).alias("_f"))
        hashed = stored(present.select(*keys, F.transform("_f", lambda f: feature_hash(f, MAX_HASH_BITS, hash_method)).alias("names")))
    units = weights.select(
        feature_hash("token", MAX_HASH_BITS, hash_method).alias("name"),
        F.round(F.col("weight") * F.lit(float(WEIGHT_UNIT))).cast("bigint").alias("units"),
    ).where("name is not null and units is not null")

    def vote(rows: pd.DataFrame, edge: np.ndarray, names: np.ndarray, at: np.ndarray, entries: pd.DataFrame) -> pd.DataFrame:
        weight = np.full(len(names), WEIGHT_UNIT, np.int64)
        weight[at >= 0] = entries["units"].to_numpy(np.int64)[at[at >= 0]]
        total = sums(weight, edge)
        signature = np.zeros(len(rows), np.uint64)
        for i in range(hash_bits):
            ahead = 2 * sums(weight * (names >> i & 1), edge) > total
            signature |= ahead.astype(np.uint64) << np.uint64(i)
        return rows[keys].assign(signature=signature.view(np.int64))

    schema = StructType([*hashed.select(*keys).schema.fields, StructField("signature", LongType())])
    return in_blocks(hashed, units, vote, schema, id_col)


def bit_vector_xor(
    docs: DataFrame,
    features: Column | str = "features",
    hash_bits: int = 64,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """``(id, vector bigint)``: XOR of all feature hashes, 0 without features."""
    check_hash_bits(hash_bits)
    keys = _keys(id_col, keep)
    hashed = _exploded(docs, features, keys).select(
        *keys, feature_hash("feature", hash_bits, hash_method).alias("h")
    )
    return hashed.groupBy(*keys).agg(
        F.coalesce(F.bit_xor("h"), F.lit(0).cast("bigint")).alias("vector")
    )


def bit_vector_weighted(
    docs: DataFrame,
    weights: DataFrame,
    features: Column | str | WordGrams = "features",
    hash_bits: int = 64,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """``(id, vector bigint)``: signed weighted vote per bit, missing tokens weigh 1."""
    voted = simhash_weighted(docs, weights, features, hash_bits, id_col, keep, hash_method)
    return voted.withColumnRenamed("signature", "vector")


def bit_sample_signature(
    vectors: DataFrame,
    sample_size: int,
    hash_bits: int = 64,
    seed: int | None = 42,
    vector: str = "vector",
) -> DataFrame:
    """Replace the bit vector by its sampled bits; no shuffle."""
    indices = sample_bit_indices(hash_bits, sample_size, seed)
    return vectors.withColumn("signature", bit_sample(vector, indices)).drop(vector)


def hybrid_signature(
    docs: DataFrame,
    features: Column | str | WordGrams = "features",
    num_hashes: int = 64,
    hash_bits: int = 24,
    seed: int | None = 42,
    id_col: str = "doc_id",
    keep: tuple[str, ...] = (),
    hash_method: str = "md5",
) -> DataFrame:
    """``(id, minhash, simhash)`` of the same feature set in one aggregation."""
    check_hash_bits(hash_bits)
    keys = _keys(id_col, keep)
    if isinstance(features, WordGrams) and hash_method == "md5":
        folded = _folded(_gram_partials(docs, features, keys, num_hashes, seed, hash_bits), keys, num_hashes, hash_bits)
        return folded.select(*keys, _minhash_array(num_hashes).alias("minhash"), _majority(hash_bits).alias("simhash"))
    hashed = _exploded(docs, features, keys).select(
        *keys,
        (feature_hash("feature", 32, hash_method) % F.lit(MINHASH_PRIME).cast("bigint")).alias("h"),
        feature_hash("feature", hash_bits, hash_method).alias("bits"),
    )
    one = F.when(F.col("bits").isNotNull(), F.lit(1).cast("bigint"))
    return (
        hashed.groupBy(*keys)
        .agg(*_minhash_minima(num_hashes, seed), *_votes(one, F.col("bits"), hash_bits))
        .select(*keys, _minhash_array(num_hashes).alias("minhash"), _majority(hash_bits).alias("simhash"))
    )
