"""LSH buckets, index probes and candidate pairs.

Candidate pairs come as a *link table* that stands for every candidate:

``id1, id2``  two documents, ``id1 < id2``
``link``      ``copy``  both have the same signature, ``id1`` is the group's smallest id;
              ``pair``  two different signatures, each shown by its smallest id
``source``    the relation that produced the row: ``minhash``, ``simhash``, ...

A group of n equal signatures takes n-1 rows instead of n(n-1)/2; different
signatures that share a bucket are all paired, in tiles, whatever the
size of the bucket. ``weighted_pairs`` counts the document pairs behind each
row and ``expand_pairs`` writes them out. Only the weighted strategy starts jobs: it
stores the pairs that it scores.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.functions.hashing import (
    bit_sample,
    bit_tables,
    bits_mask,
    check_hash_bits,
    flip_masks,
    hamming_distance,
)
from echofind.operators.bands import band_names
from echofind.operators.joins import join_lookup
from echofind.operators.tiles import equal_positions, in_grid, in_tiles

TILE_ROWS = 1000
MERGE_STRATEGIES = ("union", "intersection", "two-stage", "weighted")

Match = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


# --- groups of equal signatures -------------------------------------------------


def signature_groups(signatures: DataFrame, on: tuple[str, ...] = ("signature",), id_col: str = "doc_id") -> DataFrame:
    """One row per distinct signature: its smallest id and its number of documents.

    The counts combine before the shuffle, so a signature shared by a third of
    all documents reaches its reducer as one row per input partition.
    """
    return signatures.groupBy(*on).agg(F.min(id_col).alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))


def _links(rows: DataFrame, link: str, source: str) -> DataFrame:
    kept = [c for c in rows.columns if c == "bucket"]
    return rows.select("id1", "id2", F.lit(link).alias("link"), F.lit(source).alias("source"), *kept)


def _copy_links(
    signatures: DataFrame, groups: DataFrame, source: str, on: tuple[str, ...], id_col: str
) -> DataFrame:
    """A row from each group's smallest id to every other member."""
    repeated = groups.where("n_copies > 1").select(*on, F.col("doc_id").alias("id1"))
    members = signatures.select(*on, F.col(id_col).alias("id2"))
    return _links(join_lookup(members, repeated, list(on)).where("id2 <> id1"), "copy", source)


# --- bucket joins ---------------------------------------------------------------


def tiled_self_join(
    entries: DataFrame,
    keys: list[str],
    match: Match | None = None,
    id_col: str = "doc_id",
    tile_rows: int = TILE_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id1, id2)`` and the ``keep`` keys for two entries with equal keys that satisfy ``match``.

    A bucket of n entries is cut into ceil(n / tile_rows) tiles by a hash of
    the id, and every pair of tiles is its own join key. No task sees more
    than two tiles of a bucket and every pair is met exactly once. ``match``
    is part of the join condition, so rejected pairs are never materialised.
    """
    sizes = entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sized = (
        join_lookup(entries, sizes, keys)
        .withColumn("_tiles", F.ceil(F.col("_n") / F.lit(float(tile_rows))).cast("int"))
        .withColumn("_tile", F.pmod(F.xxhash64(id_col), F.col("_tiles").cast("bigint")).cast("int"))
        .drop("_n")
    )
    left = sized.withColumn("_other", F.explode(F.sequence("_tile", F.col("_tiles") - 1)))
    right = sized.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tile"))))
    names = sized.columns
    left = left.select(*[F.col(c).alias(f"l_{c}") for c in names], F.col("_tile").alias("_a"), F.col("_other").alias("_b"))
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in names], F.col("_other").alias("_a2"), F.col("_tile").alias("_b2"))
    condition = reduce(lambda x, y: x & y, [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys])
    condition = condition & (F.col("_a") == F.col("_a2")) & (F.col("_b") == F.col("_b2"))
    l_id, r_id = F.col(f"l_{id_col}"), F.col(f"r_{id_col}")
    condition = condition & F.when(F.col("_a") == F.col("_b"), l_id < r_id).otherwise(l_id != r_id)
    if match is not None:
        condition = condition & match(lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}"))
    kept = [F.col(f"l_{k}").alias(k) for k in keep]
    return left.join(right, condition).select(F.least(l_id, r_id).alias("id1"), F.greatest(l_id, r_id).alias("id2"), *kept)


def weighted_pairs(links: DataFrame) -> DataFrame:
    """``(id1, id2, n_pairs)``: the document pairs behind the link table of one relation.

    Each document stands for all that share its signature: a row of two ids for
    the n1 * n2 pairs between their groups, a row ``(id, id)`` for the
    n(n-1)/2 pairs of copies. Linear in the links.
    """
    sizes = links.where("link = 'copy'").groupBy(F.col("id1").alias("head")).agg((F.count(F.lit(1)) + 1).alias("n"))
    between = links.where("link = 'pair'").select("id1", "id2")
    for side in ("1", "2"):
        counts = sizes.select(F.col("head").alias(f"id{side}"), F.col("n").alias(f"n{side}"))
        between = join_lookup(between, counts, [f"id{side}"], "left")
    one = F.lit(1).cast("bigint")
    within = sizes.select(F.col("head").alias("id1"), F.col("head").alias("id2"), F.expr("n * (n - 1) div 2").alias("n_pairs"))
    counted = (F.coalesce("n1", one) * F.coalesce("n2", one)).alias("n_pairs")
    return between.select("id1", "id2", counted).unionByName(within)


def expand_pairs(links: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The plain set of candidate pairs ``(id1, id2)`` behind a link table.

    The result is as large as the definition makes it: quadratic in a group of
    copies. Use it where every pair has to be looked at, on collapsed texts.
    The table is read once for each kind of row and side: store it first.
    """
    members = (
        links.where("link = 'copy'")
        .select("source", F.col("id1").alias("head"), F.explode(F.array("id1", "id2")).alias("doc_id"))
        .distinct()
    )
    between = links.where("link = 'pair'").select("source", "id1", "id2")
    first = members.select("source", F.col("head").alias("id1"), F.col("doc_id").alias("member1"))
    second = members.select("source", F.col("head").alias("id2"), F.col("doc_id").alias("member2"))
    spread = (
        between.join(first, ["source", "id1"], "left")
        .join(second, ["source", "id2"], "left")
        .select(F.coalesce("member1", "id1").alias("a"), F.coalesce("member2", "id2").alias("b"))
        .select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2"))
    )
    within = tiled_self_join(members, ["source", "head"], tile_rows=tile_rows)
    return spread.unionByName(within).distinct()


# --- MinHash index --------------------------------------------------------------


def minhash_bands(
    signatures: DataFrame,
    num_bands: int = 10,
    rows_per_band: int = 5,
    signature: str = "signature",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(id, band, key)`` with the signature slice itself as bucket key.

    A signature shorter than ``num_bands * rows_per_band`` is an error; a null
    signature has no buckets.
    """
    if num_bands < 1 or rows_per_band < 1:
        raise ValueError("num_bands and rows_per_band must be at least 1")
    needed = num_bands * rows_per_band
    checked = F.when(
        F.size(signature) < needed,
        F.raise_error(f"num_bands * rows_per_band = {needed} exceeds the signature length").cast("array<array<bigint>>"),
    ).otherwise(
        F.array(*[F.slice(F.col(signature), 1 + k * rows_per_band, rows_per_band) for k in range(num_bands)])
    )
    return signatures.where(F.col(signature).isNotNull()).select(id_col, F.posexplode(checked).alias("band", "key"))


def _band_pairs(
    groups: DataFrame, num_bands: int, rows_per_band: int, signature: str, tile_rows: int, also: Match | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Pairs of ``groups`` that share a band bucket, each once, and satisfy ``also`` over the ``keep`` columns.

    An id travels with the 64-bit names of its bands, no array; a pair is met under its
    first shared band only, so nothing has to be deduplicated.
    """
    names = [f"_b{k}" for k in range(num_bands)]
    named = groups.where(F.col(signature).isNotNull()).select(
        "doc_id", *keep, *[name.alias(c) for c, name in zip(names, band_names(signature, num_bands, rows_per_band))]
    )
    entries = named.select("*", F.posexplode(F.array(*names)).alias("band", "key"))

    def match(left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
        first = reduce(lambda x, y: x & y, [(left("band") <= i) | (left(c) != right(c)) for i, c in enumerate(names)])
        return first if also is None else first & also(left, right)

    return tiled_self_join(entries, ["band", "key"], match, tile_rows=tile_rows)


def minhash_candidate_pairs(
    signatures: DataFrame,
    num_bands: int = 10,
    rows_per_band: int = 5,
    signature: str = "signature",
    id_col: str = "doc_id",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Link table of the documents that share at least one band bucket."""
    present = signatures.where(F.col(signature).isNotNull())
    groups = signature_groups(present, (signature,), id_col)
    pairs = _band_pairs(groups, num_bands, rows_per_band, signature, tile_rows)
    return _links(pairs, "pair", "minhash").unionByName(_copy_links(present, groups, "minhash", (signature,), id_col))


def minhash_query(
    probes: DataFrame,
    index: DataFrame,
    num_bands: int = 10,
    rows_per_band: int = 5,
    signature: str = "signature",
    probe_id: str = "probe_id",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(probe_id, id)`` of indexed documents in any bucket of a probe.

    Ids meet under the 64-bit names of their bands, no array travels. The exploded sides
    are never collected for a broadcast, whatever the session's threshold: they are
    ``num_bands`` times their table and would pass through the driver.
    """
    if num_bands < 1 or rows_per_band < 1:
        raise ValueError("num_bands and rows_per_band must be at least 1")

    def named(rows: DataFrame, key: str) -> DataFrame:
        present = rows.where(F.col(signature).isNotNull())
        return present.select(key, F.explode(F.array(*band_names(signature, num_bands, rows_per_band))).alias("_band"))

    wanted, stored = named(probes, probe_id), named(index, id_col)
    return wanted.hint("merge").join(stored, "_band").select(probe_id, id_col).distinct()


# --- SimHash index --------------------------------------------------------------


def _flipped(signature: Column, hash_bits: int, radius: int, with_self: bool) -> Column:
    masks = ([0] if with_self else []) + flip_masks(hash_bits, radius)
    if not masks:
        return F.array().cast("array<bigint>")
    # One literal for the planner, folded to an array constant.
    literal = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
    return F.transform(literal, lambda mask: signature.bitwiseXOR(mask))


def simhash_buckets(
    signatures: DataFrame,
    radius: int = 1,
    hash_bits: int = 24,
    signature: str = "signature",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(id, bucket)``: the signature and every signature within ``radius`` flips."""
    flipped = _flipped(F.col(signature), hash_bits, radius, with_self=True)
    return signatures.where(F.col(signature).isNotNull()).select(id_col, F.explode(flipped).alias("bucket"))


def block_masks(hash_bits: int, radius: int) -> list[int]:
    """Masks of which one is free of differences whenever at most ``radius`` bits differ.

    The bits are cut into ``radius + 3`` blocks (fewer if there are fewer bits) and every choice of
    all but ``radius`` blocks is a mask, so a mask keeps about 3 / (radius + 3) of the bits.
    """
    check_hash_bits(hash_bits)
    blocks = min(radius + 3, hash_bits)
    edges = [hash_bits * k // blocks for k in range(blocks + 1)]
    parts = [bits_mask(list(range(low, high))) for low, high in zip(edges, edges[1:])]
    kept = max(0, blocks - radius)
    return [reduce(lambda x, y: x | y, chosen, 0) for chosen in combinations(parts, kept)]


def _masked_entries(rows: DataFrame, masks: list[int], signature: str) -> DataFrame:
    values = F.array(*[F.col(signature).bitwiseAND(F.lit(m).cast("bigint")) for m in masks])
    return rows.select("*", F.posexplode(values).alias("part", "key"))


def first_shared(part: Column, difference: Column, masks: list[int]) -> Column:
    """True when no earlier part is equal, so that a pair is met in one part only."""
    zero = F.lit(0).cast("bigint")
    return reduce(
        lambda x, y: x & y,
        [(part <= i) | (difference.bitwiseAND(F.lit(m).cast("bigint")) != zero) for i, m in enumerate(masks)],
    )


def _pairs_by_masks(
    groups: DataFrame, masks: list[int], radius: int, signature: str, tile_rows: int, also: Match | None = None, buckets: bool = False
) -> DataFrame:
    """Pairs of ``groups`` whose signatures are equal under a mask and within ``radius``.

    A pair is met under its first mask only, and ``also`` is part of the join. With ``buckets``
    each says in which ``bucket`` it is met.
    """
    entries = _masked_entries(groups, masks, signature)

    def match(left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
        a, b = left(signature), right(signature)
        near = (hamming_distance(a, b) <= radius) & first_shared(left("part"), a.bitwiseXOR(b), masks)
        return near if also is None else near & also(left, right)

    if not buckets:
        return tiled_self_join(entries, ["part", "key"], match, tile_rows=tile_rows)
    met = tiled_self_join(entries, ["part", "key"], match, tile_rows=tile_rows, keep=("part", "key"))
    return met.select("id1", "id2", F.xxhash64("part", "key").alias("bucket"))


def simhash_candidate_pairs(
    signatures: DataFrame,
    radius: int = 1,
    hash_bits: int = 24,
    signature: str = "signature",
    id_col: str = "doc_id",
    tile_rows: int = TILE_ROWS,
    buckets: bool = False,
) -> DataFrame:
    """Link table of the documents within Hamming distance ``radius``.

    Distinct signatures meet under the masks of ``block_masks``, the distance is
    verified in the join. Exact for every radius. With ``buckets`` each link also has the
    ``bucket`` in which it is met, null for copies.
    """
    present = signatures.where(F.col(signature).isNotNull())
    groups = signature_groups(present, (signature,), id_col)
    masks = block_masks(hash_bits, radius)
    pairs = _pairs_by_masks(groups.select("doc_id", signature), masks, radius, signature, tile_rows, buckets=buckets)
    copies = _copy_links(present, groups, "simhash", (signature,), id_col)
    return _links(pairs, "pair", "simhash").unionByName(copies, allowMissingColumns=buckets)


def simhash_query(
    probes: DataFrame,
    index: DataFrame,
    radius: int = 1,
    hash_bits: int = 24,
    signature: str = "signature",
    probe_id: str = "probe_id",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(probe_id, id)`` of indexed signatures within ``radius`` of a probe."""
    wanted = probes.where(F.col(signature).isNotNull())
    return _masked_query(wanted, index, block_masks(hash_bits, radius), radius, signature, probe_id, id_col)


def _masked_query(
    probes: DataFrame, index: DataFrame, masks: list[int], radius: int, signature: str, probe_id: str, id_col: str
) -> DataFrame:
    """Probe on parts of the signature; only distinct signatures are compared."""
    asked = probes.select(probe_id, F.col(signature).alias("probe_sig"))
    stock = index.select(id_col, F.col(signature).alias("index_sig"))
    left = _masked_entries(asked.select("probe_sig").distinct(), masks, "probe_sig")
    right = _masked_entries(stock.select("index_sig").distinct(), masks, "index_sig")
    difference = F.col("probe_sig").bitwiseXOR(F.col("index_sig"))
    matched = (
        left.hint("merge")
        .join(right, ["part", "key"])
        .where((F.bit_count(difference) <= radius) & first_shared(F.col("part"), difference, masks))
        .select("probe_sig", "index_sig")
    )
    return matched.join(asked, "probe_sig").join(stock, "index_sig").select(probe_id, id_col)


# --- bit-sampling index ---------------------------------------------------------


def bitsampling_buckets(
    signatures: DataFrame,
    num_tables: int = 2,
    bits_per_table: int = 16,
    hash_bits: int = 24,
    seed: int | None = 42,
    signature: str = "signature",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(id, tbl, key)``: the sampled bits of the signature in every table."""
    tables = bit_tables(hash_bits, num_tables, bits_per_table, seed)
    keys = F.array(*[bit_sample(signature, indices) for indices in tables])
    return signatures.where(F.col(signature).isNotNull()).select(id_col, F.posexplode(keys).alias("tbl", "key"))


def bitsampling_candidate_pairs(
    signatures: DataFrame,
    radius: int | None = 1,
    num_tables: int = 2,
    bits_per_table: int = 16,
    hash_bits: int = 24,
    seed: int | None = 42,
    signature: str = "signature",
    id_col: str = "doc_id",
    tile_rows: int = TILE_ROWS,
    buckets: bool = False,
) -> DataFrame:
    """Link table of the documents that share a table bucket and lie within ``radius``.

    Sharing a bucket means that the XOR of two signatures is zero under the
    table's mask. Without a radius every shared bucket counts. ``buckets`` as in ``simhash_candidate_pairs``.
    """
    masks = [bits_mask(indices) for indices in bit_tables(hash_bits, num_tables, bits_per_table, seed)]
    present = signatures.where(F.col(signature).isNotNull())
    groups = signature_groups(present, (signature,), id_col)
    within = hash_bits if radius is None else radius
    pairs = _pairs_by_masks(groups.select("doc_id", signature), masks, within, signature, tile_rows, buckets=buckets)
    copies = _copy_links(present, groups, "bitsampling", (signature,), id_col)
    return _links(pairs, "pair", "bitsampling").unionByName(copies, allowMissingColumns=buckets)


def bitsampling_query(
    probes: DataFrame,
    index: DataFrame,
    radius: int | None = 1,
    num_tables: int = 2,
    bits_per_table: int = 16,
    hash_bits: int = 24,
    seed: int | None = 42,
    signature: str = "signature",
    probe_id: str = "probe_id",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(probe_id, id)`` of indexed signatures in a probe's table buckets and ``radius``."""
    masks = [bits_mask(t) for t in bit_tables(hash_bits, num_tables, bits_per_table, seed)]
    wanted = probes.where(F.col(signature).isNotNull())
    within = hash_bits if radius is None else radius
    return _masked_query(wanted, index, masks, within, signature, probe_id, id_col)


# --- hybrid index ---------------------------------------------------------------


def weighted_score(
    m: Column, s: Column, weights: tuple[float, float], weighted_threshold: float, minhash_threshold: float
) -> Column:
    score = F.lit(weights[0]) * m + F.lit(weights[1]) * s
    return (m >= minhash_threshold) & (score >= weighted_threshold)


def hybrid_pairs(
    signatures: DataFrame,
    strategy: str = "union",
    num_bands: int = 10,
    rows_per_band: int = 5,
    radius: int = 1,
    hash_bits: int = 24,
    weights: tuple[float, float] = (0.95, 0.05),
    weighted_score_threshold: float = 0.65,
    minhash_score_threshold: float = 0.3,
    id_col: str = "doc_id",
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Link table of MinHash and SimHash candidates merged by ``strategy``.

    Documents that agree in both signatures are one group. Groups are paired
    by the buckets of either index, and what a strategy asks of their
    signatures is part of that join, so a rejected pair never exists.
    """
    if strategy not in MERGE_STRATEGIES:
        raise ValueError(f"Unknown merge strategy {strategy!r}; use one of {MERGE_STRATEGIES}")
    on = ("minhash", "simhash")
    if strategy == "union":
        present = signatures.where("minhash is not null or simhash is not null")
    else:
        present = signatures.where("minhash is not null and simhash is not null")
    groups = signature_groups(present, on, id_col).select(*on, "doc_id")
    copies = _copy_links(present, signature_groups(present, on, id_col), "hybrid", on, id_col)

    def near(left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
        # The SimHash relation is exactly "distance <= radius", so intersecting with
        # it and filtering the MinHash candidates by it are the same set.
        return hamming_distance(left("simhash"), right("simhash")) <= radius

    if strategy in ("intersection", "two-stage"):
        pairs = _band_pairs(groups, num_bands, rows_per_band, "minhash", tile_rows, near, ("simhash",))
    else:
        pairs = _band_pairs(groups, num_bands, rows_per_band, "minhash", tile_rows)
        hashed = groups.where("simhash is not null").select("doc_id", "simhash")
        masks = block_masks(hash_bits, radius)
        pairs = pairs.unionByName(_pairs_by_masks(hashed, masks, radius, "simhash", tile_rows)).distinct()
    if strategy == "weighted":
        # Ids first; then each tile of pairs gets the signatures of its documents once.
        judged = in_tiles(pairs, groups, equal_positions, ("equal", "length", "distance"))
        m, s = F.col("equal") / F.col("length"), F.lit(1.0) - F.col("distance") / F.lit(float(hash_bits))
        kept = weighted_score(m, s, weights, weighted_score_threshold, minhash_score_threshold)
        pairs = judged.where(kept).select("id1", "id2")
    if strategy == "weighted":
        # Documents that agree in both signatures score m = s = 1.
        best = F.lit(1.0)
        copies = copies.where(weighted_score(best, best, weights, weighted_score_threshold, minhash_score_threshold))
    return _links(pairs, "pair", "hybrid").unionByName(copies)


def hybrid_query(
    probes: DataFrame,
    index: DataFrame,
    strategy: str = "union",
    num_bands: int = 10,
    rows_per_band: int = 5,
    radius: int = 1,
    hash_bits: int = 24,
    weights: tuple[float, float] = (0.95, 0.05),
    weighted_score_threshold: float = 0.65,
    minhash_score_threshold: float = 0.3,
    probe_id: str = "probe_id",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(probe_id, id)`` of the two index probes merged by ``strategy``."""
    if strategy not in MERGE_STRATEGIES:
        raise ValueError(f"Unknown merge strategy {strategy!r}; use one of {MERGE_STRATEGIES}")
    banded = minhash_query(probes, index, num_bands, rows_per_band, "minhash", probe_id, id_col)
    near = simhash_query(probes, index, radius, hash_bits, "simhash", probe_id, id_col)
    if strategy == "union":
        return banded.unionByName(near).distinct()
    if strategy == "intersection":
        return banded.intersect(near)

    if strategy == "two-stage":
        asked = probes.select(probe_id, F.col("simhash").alias("simhash_1"))
        held = index.select(id_col, F.col("simhash").alias("simhash_2"))
        judged = banded.join(asked, probe_id).join(held, id_col)
        return judged.where(hamming_distance("simhash_1", "simhash_2") <= radius).select(probe_id, id_col)
    return weighted_found(
        banded.unionByName(near).distinct(), probes, index, hash_bits, weights, weighted_score_threshold, minhash_score_threshold, probe_id, id_col
    )


def weighted_found(
    found: DataFrame,
    probes: DataFrame,
    index: DataFrame,
    hash_bits: int,
    weights: tuple[float, float],
    weighted_threshold: float,
    minhash_threshold: float,
    probe_id: str = "probe_id",
    id_col: str = "doc_id",
) -> DataFrame:
    """The rows of ``found`` (probe_id, id) that pass both score thresholds.

    Ids only are paired; each cell of a grid over both sides gets the signatures of
    its documents once. The pairs are stored first.
    """
    asked, held = probes.select(probe_id, "minhash", "simhash"), index.select(id_col, "minhash", "simhash")
    judged = in_grid(found, asked, held, equal_positions, ("equal", "length", "distance"), probe_id, id_col)
    m = F.col("equal") / F.nullif("length", F.lit(0))
    s = F.lit(1.0) - F.col("distance") / F.lit(float(hash_bits))
    known = (F.col("equal") >= 0) & (F.col("distance") >= 0)
    return judged.where(known & weighted_score(m, s, weights, weighted_threshold, minhash_threshold)).select(probe_id, id_col)
