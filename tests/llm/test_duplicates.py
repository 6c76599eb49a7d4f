"""Jaccard components, suffix and chunk deduplication and components against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest

from echofind.llm import chunk_dedup, jaccard_join, suffix_dedup
from echofind.llm.components import components


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=3):
    """Near copies of several sizes, exact copies, a shared passage, edge texts and repeated rows."""
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "one", "one two three four", "ONE two three  four", "A b c d e", "a B c d e", "a b c d e f"]
    shared = words(rng, 60)
    for size in (6, 9, 14, 25, 40, 90, 300, 800):
        for _ in range(3):
            base = words(rng, size)
            texts += [" ".join(base)] * rng.randrange(1, 3)
            for _ in range(6):
                copy = list(base)
                for _ in range(rng.randrange(0, 1 + size // 25)):
                    copy[rng.randrange(len(copy))] = "edit"
                texts.append(" ".join(copy))
    for _ in range(25):
        body = words(rng, rng.randrange(20, 120))
        at = rng.randrange(len(body))
        texts.append(" ".join(body[:at] + shared + body[at:]))
    chain = words(rng, 200)
    for i in range(12):  # each links with the next, the ends do not
        texts.append(" ".join(chain[:200 - 12] + [f"c{i + j}" for j in range(12)] + chain[188:]))
    rows = [(100 + 7 * i, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[40]] + [(None, "a b c d e")]


def plain_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_components(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int").repartition(5)
    want = plain_components([r for r in rows if r[0] is not None])
    got = jaccard_join.jaccard_components(df).collect()
    assert len(got) == len(rows) - 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    kept = jaccard_join.deduplicate(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, (_, c) in want.items() if i == c}


@pytest.mark.parametrize("band", range(10))
def test_keys_of_linked_sets_meet(band):
    """Sets at the very edge of a link share a key, whatever is frequent."""
    rng = np.random.default_rng(band)
    low, high = jaccard_join.bands()[band]
    none = np.zeros(0, np.uint64), np.zeros(0)
    for _ in range(60):
        n = int(rng.integers(low, high + 1))
        union = np.unique(rng.integers(0, 1 << 63, n + n // 4, dtype=np.uint64))
        a, b = union[: len(union) - n // 8], union[n // 8 :]
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        frequent = np.sort(rng.choice(union, len(union) // 2, replace=False))
        for table in (none, (frequent, rng.integers(1, 50, len(frequent)).astype(float))):
            keys = [np.concatenate([jaccard_join.segment_keys(s, k, *table) for k in jaccard_join._bands_of(len(s))]) for s in (a, b)]
            assert len(np.intersect1d(*keys)), (len(a), len(b), common)


def joined(count, pairs):
    label = list(range(count))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        label[max(x, y)] = min(x, y)
    return [root(x) for x in range(count)]


def short_sets(count, seed=8):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, (60, 16), dtype=np.uint64)
    return [np.unique(np.concatenate([base[i % 60][: 16 - i % 3], rng.integers(0, 1 << 63, i % 5, dtype=np.uint64)])) for i in range(count)]


def plain_links(sets):
    """Pairs that link; sets of different bases share nothing."""
    beside = [(a, b) for k in range(60) for a in range(k, len(sets), 60) for b in range(a + 60, len(sets), 60)]
    return [(a, b) for a, b in beside if 180 * len(np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]))]


def test_forest_of_many_short_sets():
    """The forest of two tiles against every pair of sets, in memory linear in the sets; sketches connect no less."""
    sets = short_sets(3_000)
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    n = np.array([len(sets[i]) for i in order])
    tracemalloc.start()
    found = jaccard_join.spanning(np.array(order), jaccard_join.Sets(n, [sets[i].tobytes() for i in order]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000 * len(sets)
    want = plain_links(sets)
    assert joined(len(sets), found) == joined(len(sets), want) and len(found) < len(want)
    maybe = joined(len(sets), jaccard_join.spanning(np.array(order), jaccard_join.Sketches(n, [jaccard_join.sketch(sets[i]).tobytes() for i in order])))
    assert all(maybe[a] == maybe[b] for a, b in want)


def test_sketches_never_reject_a_link():
    rng = np.random.default_rng(3)
    for n in (4, 30, 60, 63, 64, 120, 130, 250, 500, 1100):
        union = np.unique(rng.integers(0, 1 << 63, n + n // 8, dtype=np.uint64))
        sets = sorted((np.sort(rng.choice(union, int(k), replace=False)) for k in rng.integers(max(1, n - n // 8), len(union) + 1, 30)), key=len)
        size = np.array([len(s) for s in sets])
        rough = jaccard_join.Sketches(size, [jaccard_join.sketch(s).tobytes() for s in sets])
        exact = jaccard_join.Sets(size, [s.tobytes() for s in sets])
        for i in range(len(sets)):
            rows = np.arange(len(sets))
            link = exact.near(i, rows)
            assert link.tolist() == [180 * len(np.intersect1d(sets[i], s)) >= 80 * (len(sets[i]) + len(s)) for s in sets]
            assert (rough.near(i, rows) | ~link).all()


@pytest.mark.parametrize("tile", [2_000, 20])
def test_tiles_of_families(spark, monkeypatch, tile):
    """Families of several tiles, with sets that the hub does not link with, against every pair."""
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    sets = short_sets(400)
    rows = [(i % 60 % 2, i, len(s), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    held = jaccard_join.written(jaccard_join.tiled(spark.createDataFrame(rows, "family long, node long, n long, data binary")))
    assert held.agg({"tiles": "max"}).first()[0] == max(1, 200 // tile)
    found = jaccard_join.forest(held, jaccard_join.Sets)
    assert joined(400, [tuple(r) for r in found.collect()]) == joined(400, plain_links(sets))


def test_tiles_are_dealt_out_by_themselves(spark):
    """Rows that are partitioned by family still move by the hash of family and tile."""
    rows = spark.createDataFrame([(1, 1, 1, 1, 1, 0, bytearray(8))], "family long, node long, n long, hub long, tiles int, tile int, data binary")
    plan = jaccard_join._dealt(rows.repartition("family"), jaccard_join.Sets, False, "family", "tile")._jdf.queryExecution().toString()
    assert "hashpartitioning(deal" in plan


def test_texts_of_one_id(spark):
    """Two texts of one doc_id are two sets; a link with either counts."""
    one, other = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    rows = [(1, one), (1, other), (1, one), (2, one + " x"), (3, other + " y"), (4, "a b c")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_only_texts_that_are_asked_for_move(spark):
    """Of many texts without relatives none reaches the join with the chosen sets."""
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, 60, 10**6))) for i in range(300)] + [(300, "a " * 30), (301, "a " * 30 + "b"), (None, "a " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = docs.filter("doc_id in (7, 300, 301)").select("doc_id")
    kept = jaccard_join.asked_for(docs, wanted)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [7, 300, 301]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert jaccard_join.asked_for(docs, wanted.limit(0)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(2)
    base = words(rng, 300_000, 10**6)
    near = [*base[:-2], "x", "y"]
    rows = [(3, " ".join(base)), (5, " ".join(near)), (7, " ".join(base[:1000])), (9, "z" * 3_000_000), (11, "z" * 3_000_000)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(3, 3), (5, 3), (7, 7), (9, 9), (11, 9)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}


def plain_suffixes(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in sorted(texts):
        for s in range(len(t) - 49):
            first.setdefault(t[s : s + 50], i)
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < i:
                gone[s : s + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(t) > 0 and gone[0])
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("block_bytes", "hot_contexts"), [(2 << 20, 256), (3_000, 2), (400, 0)])
def test_suffixes(spark, block_bytes, hot_contexts):
    rng = random.Random(9)
    passage = "é" + "".join(rng.choice("abcde ") for _ in range(180))
    texts = [None, "", "x" * 49, "x" * 50, "x" * 300, "ab" * 120, passage, passage, passage[:60], passage[:49]]
    texts += ["".join(rng.choice("abc") for _ in range(rng.randrange(200))) + passage + "".join(rng.choice("abc") for _ in range(rng.randrange(90))) for _ in range(30)]
    rows = [(1000 - 11 * i, t) for i, t in enumerate(texts)]
    rows.append(rows[6])
    df = spark.createDataFrame([(i, t, "k") for i, t in [*rows, (None, passage)]], "doc_id long, text string, kept string").repartition(3)
    got = suffix_dedup.deduplicate(df, block_bytes=block_bytes, hot_contexts=hot_contexts).collect()
    assert sorted(tuple(r)[:5] for r in got) == plain_suffixes(rows)
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in got)


def plain_gear(data):
    codes = [int(c) >> 32 for c in chunk_dedup.byte_codes()]
    h, out = 0, []
    for b in data:
        h = (h * 2 + codes[b]) & 0xFFFFFFFF
        out.append(h)
    return out


def test_chunks(spark):
    rng = random.Random(4)
    data = bytes(rng.randrange(256) for _ in range(3000))
    assert chunk_dedup.gear(np.frombuffer(data, np.uint8)).tolist() == plain_gear(data)
    (ends,) = chunk_dedup.text_chunks([data])
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunk_dedup.MOST and sizes[:-1].min() >= chunk_dedup.LEAST
    passage = " ".join(words(rng, 600))
    texts = [None, "", "short", passage, "inserted " + passage, " ".join(words(rng, 30)) + passage + " tail", "short", passage, None]
    (ends,) = chunk_dedup.text_chunks([passage.encode()])
    texts.append(" ".join(words(rng, 40, 10**4)) + " " + passage[ends[2] - 17 : ends[3] + 17] + " " + " ".join(words(rng, 40, 10**4)))
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_removed int")
    rows = {r["doc_id"]: r for r in chunk_dedup.deduplicate(df).collect()}
    seen, want, single = {}, {}, {}
    for i, t in enumerate(texts):
        e = (t or "").encode()
        (ends,) = chunk_dedup.text_chunks([e])
        runs = []
        for s, end in zip([0, *ends[:-1]], ends, strict=False):
            first = seen.setdefault(e[s:end], (i, s))
            if first == (i, s):
                continue
            places = (first[1], first[1] + end - s)
            if runs and runs[-1][1] == s and runs[-1][3] == first[0] and first[1] in runs[-1][4]:
                runs[-1] = (runs[-1][0], end, runs[-1][2] + 1, first[0], places)
            else:
                runs.append((s, end, 1, first[0], places))
        want[i] = [r for r in runs if r[1] - r[0] >= 100 or r[1] - r[0] == len(e)]
        single[i] = sum(r[2] for r in runs) - sum(r[2] for r in want[i])
    assert {i: [(x["start"], x["end"], x["first_doc"]) for x in r["removed"]] for i, r in rows.items()} == {i: [(a, b, d) for a, b, _, d, _ in w] for i, w in want.items()}
    assert all((r["n_removed"], r["n_duplicates"], r["n_single"]) == (sum(b - a for a, b, *_ in want[i]), sum(w[2] for w in want[i]), single[i]) for i, r in rows.items())
    assert rows[4]["n_removed"] > 0.8 * len(passage) and rows[7]["n_removed"] == len(passage) and rows[6]["n_removed"] == 5
    assert rows[9]["n_removed"] == 0 and rows[9]["n_single"] > 0
    long = spark.createDataFrame([(1, "z" * 2_000_000), (1, "z" * 2_000_000), (2, None), (3, "z" * 2_000_000)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"] > 1_999_000) for r in chunk_dedup.deduplicate(long).collect()) == [(1, True), (1, True), (2, False), (3, True)]


def test_chunks_of_short_passages():
    """Passages of 51 words in different contexts share chunks, also those that repeat a word or one character."""
    rng = random.Random(12)
    passages = [" ".join(words(rng, 51, 10**4)) for _ in range(300)]
    passages += [" ".join([w] * 51) for w in ("la,", "un", "die", "enchch", "eronon.", "x")] + ["z" * 200, "ab" * 100]
    for passage in passages:
        shared = []
        for _ in range(2):
            before, after = (" ".join(words(rng, rng.randrange(1, 60), 10**4)) for _ in range(2))
            data = f"{before} {passage} {after}".encode()
            at, end = len(before) + 1, len(before) + 1 + len(passage)
            (ends,) = chunk_dedup.text_chunks([data])
            shared.append({data[a:b]: b - a for a, b in zip([0, *ends[:-1]], ends, strict=True) if at <= a and b <= end})
        assert set(shared[0]) & set(shared[1]), passage


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_components(none).count() == 0
    assert suffix_dedup.deduplicate(none).count() == 0
    assert chunk_dedup.deduplicate(none).count() == 0
