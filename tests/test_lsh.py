"""Index operators against brute force over all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from echofind.functions import hashing
from echofind.operators import lsh


def pair_set(frame):
    rows = [(r["id1"], r["id2"]) for r in frame.select("id1", "id2").collect()]
    assert len(rows) == len(set(rows)) and all(a < b for a, b in rows)
    return set(rows)


def brute(signatures, related):
    return {(a, b) for a, b in combinations(sorted(signatures), 2) if related(signatures[a], signatures[b])}


def share_band(bands, rows):
    return lambda x, y: any(x[k * rows : (k + 1) * rows] == y[k * rows : (k + 1) * rows] for k in range(bands))


def distance(x, y):
    return ((x ^ y) & (2**64 - 1)).bit_count()


@pytest.fixture(scope="module")
def minhashes(spark):
    """Few values per position, so that bands collide; a third are copies of one signature."""
    draw = random.Random(3)
    rows = {i: [draw.randint(0, 3) for _ in range(6)] for i in range(80)}
    rows |= {i: [9, 9, 9, 9, 9, 9] for i in range(80, 120)}
    frame = spark.createDataFrame([*rows.items(), (500, None)], "doc_id bigint, signature array<bigint>").repartition(5)
    return rows, frame.cache()


@pytest.fixture(scope="module")
def simhashes(spark):
    draw = random.Random(5)
    rows = {}
    for i in range(60):
        base = draw.getrandbits(24)
        rows[2 * i] = base
        rows[2 * i + 1] = base ^ (1 << draw.randrange(24)) ^ (1 << draw.randrange(24))
    rows |= {i: 12345 for i in range(200, 240)}
    return rows, spark.createDataFrame(list(rows.items()), "doc_id bigint, signature bigint").repartition(5).cache()


@pytest.mark.parametrize("tile_rows", [1, 4, 1000])
def test_minhash_pairs_equal_brute_force(minhashes, tile_rows):
    rows, frame = minhashes
    links = lsh.minhash_candidate_pairs(frame, 3, 2, tile_rows=tile_rows).cache()
    expected = brute(rows, share_band(3, 2))
    assert pair_set(lsh.expand_pairs(links, tile_rows)) == expected
    assert {r["link"] for r in links.select("link").distinct().collect()} == {"copy", "pair"}
    distinct = len({tuple(s) for s in rows.values()})
    assert links.where("link = 'copy'").count() == len(rows) - distinct


def weights(rows, expected):
    """Pairs counted between the smallest ids of equal signatures."""
    head = {}
    for i in sorted(rows):
        head.setdefault(str(rows[i]), i)
    found = {}
    for a, b in expected:
        key = tuple(sorted((head[str(rows[a])], head[str(rows[b])])))
        found[key] = found.get(key, 0) + 1
    return found


def test_weighted_pairs(minhashes, simhashes):
    rows, frame = minhashes
    found = lsh.weighted_pairs(lsh.minhash_candidate_pairs(frame, 3, 2)).collect()
    assert {(r["id1"], r["id2"]): r["n_pairs"] for r in found} == weights(rows, brute(rows, share_band(3, 2)))
    rows, frame = simhashes
    found = lsh.weighted_pairs(lsh.simhash_candidate_pairs(frame, 2, 24)).collect()
    assert {(r["id1"], r["id2"]): r["n_pairs"] for r in found} == weights(rows, brute(rows, lambda x, y: distance(x, y) <= 2))


def test_a_bucket_of_many_signatures(spark):
    """1,200 different signatures in one bucket give all their pairs."""
    frame = spark.range(1200).select(F.col("id").alias("doc_id"), F.array(F.lit(1).cast("bigint"), F.col("id")).alias("signature"))
    links = lsh.minhash_candidate_pairs(frame, 1, 1)
    assert links.count() == 1200 * 1199 // 2


def test_index_operators_start_no_job(minhashes, simhashes, spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "building plans only")
    links = lsh.minhash_candidate_pairs(minhashes[1], 3, 2)
    lsh.expand_pairs(links), lsh.weighted_pairs(links)
    lsh.simhash_candidate_pairs(simhashes[1], 2, 24), lsh.bitsampling_candidate_pairs(simhashes[1], 2, 3, 8, 24)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_minhash_bands(minhashes):
    _, frame = minhashes
    bands = lsh.minhash_bands(frame.where("doc_id = 80"), 3, 2).collect()
    assert [(r["band"], r["key"]) for r in sorted(bands, key=lambda r: r["band"])] == [(k, [9, 9]) for k in range(3)]
    assert lsh.minhash_bands(frame.where("doc_id = 500"), 3, 2).count() == 0
    with pytest.raises(Exception, match="exceeds the signature length"):
        lsh.minhash_bands(frame, 4, 2).collect()
    with pytest.raises(ValueError):
        lsh.minhash_bands(frame, 0, 2)


def test_minhash_query(minhashes, spark):
    rows, frame = minhashes
    probes = {1000: rows[0], 1001: [9, 9, 0, 0, 0, 0], 1002: [7, 7, 7, 7, 7, 7]}
    asked = spark.createDataFrame(list(probes.items()), "probe_id bigint, signature array<bigint>")
    found = {tuple(r) for r in lsh.minhash_query(asked, frame, 3, 2).collect()}
    related = share_band(3, 2)
    assert found == {(p, d) for p, x in probes.items() for d, y in rows.items() if related(x, y)}
    assert (1000, 0) in found


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_simhash_pairs_equal_brute_force(simhashes, radius):
    rows, frame = simhashes
    links = lsh.simhash_candidate_pairs(frame, radius, 24, tile_rows=16)
    assert pair_set(lsh.expand_pairs(links)) == brute(rows, lambda x, y: distance(x, y) <= radius)


def test_simhash_pairs_use_all_64_bits(spark):
    draw = random.Random(8)
    rows = {1: 0, 2: -(2**63), 3: -1, 4: 2**63 - 1, 5: 1}
    for i in range(10, 60):
        base = draw.getrandbits(63)
        rows |= {i: base, i + 100: base ^ sum(1 << b for b in draw.sample(range(63), draw.randrange(1, 6)))}
    frame = spark.createDataFrame(list(rows.items()), "doc_id bigint, signature bigint")
    for radius in (1, 3, 4):
        links = lsh.simhash_candidate_pairs(frame, radius, 64)
        assert pair_set(links) == brute(rows, lambda x, y, r=radius: distance(x, y) <= r)


@pytest.mark.parametrize("hash_bits,radius", [(24, 0), (24, 1), (24, 3), (5, 3), (3, 4), (64, 2)])
def test_some_mask_is_free_of_differences(hash_bits, radius):
    masks = lsh.block_masks(hash_bits, radius)
    draw = random.Random(hash_bits)
    for _ in range(300):
        flips = draw.sample(range(hash_bits), draw.randrange(0, min(radius, hash_bits) + 1))
        assert any(mask & sum(1 << b for b in flips) == 0 for mask in masks)


def test_simhash_buckets(spark):
    frame = spark.createDataFrame([(1, 0b101)], "doc_id bigint, signature bigint")
    buckets = [r["bucket"] for r in lsh.simhash_buckets(frame, 1, 3).collect()]
    assert sorted(buckets) == sorted([0b101, 0b100, 0b111, 0b001])
    assert lsh.simhash_buckets(frame, 2, 4).count() == 1 + 4 + 6


def test_simhash_query(simhashes, spark):
    rows, frame = simhashes
    probes = {1: rows[0] ^ 1, 2: 12345, 3: 12345 ^ 0b11}
    asked = spark.createDataFrame(list(probes.items()), "probe_id bigint, signature bigint")
    found = lsh.simhash_query(asked, frame, 2, 24).collect()
    expected = {(p, d) for p, x in probes.items() for d, y in rows.items() if distance(x, y) <= 2}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def share_table(tables):
    return lambda x, y: any(all((x >> i & 1) == (y >> i & 1) for i in t) for t in tables)


@pytest.mark.parametrize("radius", [1, 2, 4, None])
def test_bitsampling_pairs_equal_brute_force(simhashes, radius):
    rows, frame = simhashes
    tables = hashing.bit_tables(24, 3, 8, 42)
    shared = share_table(tables)
    links = lsh.bitsampling_candidate_pairs(frame, radius, 3, 8, 24, tile_rows=8)
    limit = 24 if radius is None else radius
    assert pair_set(lsh.expand_pairs(links)) == brute(rows, lambda x, y: shared(x, y) and distance(x, y) <= limit)


def test_bitsampling_query_and_buckets(simhashes, spark):
    rows, frame = simhashes
    tables = hashing.bit_tables(24, 3, 8, 42)
    shared = share_table(tables)
    probes = {1: rows[0] ^ 1, 2: 12345}
    asked = spark.createDataFrame(list(probes.items()), "probe_id bigint, signature bigint")
    for radius in (2, None):
        found = lsh.bitsampling_query(asked, frame, radius, 3, 8, 24).collect()
        limit = 24 if radius is None else radius
        expected = {(p, d) for p, x in probes.items() for d, y in rows.items() if shared(x, y) and distance(x, y) <= limit}
        assert len(found) == len(expected) and {tuple(r) for r in found} == expected
    buckets = lsh.bitsampling_buckets(frame.where("doc_id = 200"), 3, 8, 24).collect()
    assert {r["tbl"]: r["key"] for r in buckets} == {
        t: sum((12345 >> index & 1) << i for i, index in enumerate(indices)) for t, indices in enumerate(tables)
    }
    with pytest.raises(ValueError):
        lsh.bitsampling_buckets(frame, 2, 32, 24)


@pytest.fixture(scope="module")
def hybrids(minhashes, simhashes, spark):
    minhash, _ = minhashes
    simhash, _ = simhashes
    values = list(simhash.values())
    rows = {d: (m, values[d % 7] if d % 3 else values[d]) for d, m in minhash.items()}
    frame = spark.createDataFrame(
        [(d, m, s) for d, (m, s) in rows.items()] + [(500, None, 0)],
        "doc_id bigint, minhash array<bigint>, simhash bigint",
    )
    return rows, frame.cache()


@pytest.mark.parametrize("strategy", lsh.MERGE_STRATEGIES)
def test_hybrid_pairs_equal_brute_force(hybrids, strategy):
    rows, frame = hybrids
    banded = share_band(3, 2)

    def near(x, y):
        return distance(x[1], y[1]) <= 1

    def score(x, y):
        m = sum(a == b for a, b in zip(x[0], y[0])) / 6
        s = 1 - distance(x[1], y[1]) / 24
        return m >= 0.3 and 0.6 * m + 0.4 * s >= 0.65

    rules = {
        "union": lambda x, y: banded(x[0], y[0]) or near(x, y),
        "intersection": lambda x, y: banded(x[0], y[0]) and near(x, y),
        "two-stage": lambda x, y: banded(x[0], y[0]) and near(x, y),
        "weighted": lambda x, y: (banded(x[0], y[0]) or near(x, y)) and score(x, y),
    }
    present = dict(rows)
    links = lsh.hybrid_pairs(frame.where("doc_id < 500"), strategy, 3, 2, 1, 24, (0.6, 0.4), 0.65, 0.3, tile_rows=4)
    assert pair_set(lsh.expand_pairs(links)) == brute(present, rules[strategy])
    probes = frame.where("doc_id in (0, 50, 90)").withColumnRenamed("doc_id", "probe_id")
    found = lsh.hybrid_query(probes, frame.where("doc_id < 500"), strategy, 3, 2, 1, 24, (0.6, 0.4), 0.65, 0.3).collect()
    expected = {(p, d) for p in (0, 50, 90) for d in present if rules[strategy](present[p], present[d])}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_weighted_copies_follow_the_threshold(hybrids):
    _, frame = hybrids
    links = lsh.hybrid_pairs(frame, "weighted", 3, 2, 1, 24, (0.3, 0.3), 0.65, 0.3)
    assert links.count() == 0
    with pytest.raises(ValueError):
        lsh.hybrid_pairs(frame, "vote")
    with pytest.raises(ValueError):
        lsh.hybrid_query(frame, frame, "vote")


def test_empty_signatures(spark):
    empty = spark.createDataFrame([], "doc_id bigint, signature array<bigint>")
    assert lsh.expand_pairs(lsh.minhash_candidate_pairs(empty, 3, 2)).count() == 0


def test_no_cartesian_product(minhashes, simhashes):
    plans = [
        lsh.minhash_candidate_pairs(minhashes[1], 3, 2),
        lsh.simhash_candidate_pairs(simhashes[1], 1, 24),
        lsh.simhash_candidate_pairs(simhashes[1], 4, 24),
        lsh.bitsampling_candidate_pairs(simhashes[1], 4, 3, 8, 24),
        lsh.expand_pairs(lsh.minhash_candidate_pairs(minhashes[1], 3, 2)),
    ]
    for frame in plans:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tiles_meet_every_pair_once(spark):
    frame = spark.range(57).select(F.col("id").alias("doc_id"), F.lit(1).alias("key"))
    for tile_rows in (1, 5, 1000):
        assert pair_set(lsh.tiled_self_join(frame, ["key"], tile_rows=tile_rows)) == set(combinations(range(57), 2))
