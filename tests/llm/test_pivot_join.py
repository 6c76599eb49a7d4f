"""SimHash fingerprints and their links against plain Python."""

import random

import numpy as np
import pytest
import xxhash

from echofind.llm import pivot_join
from echofind.llm.common import mix


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """(doc_id, fingerprint, least doc_id reachable) by comparing all pairs."""
    fps = [f for _, f in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                group[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((d, f"{f:016x}", least.get(root(i))) for i, (d, f) in enumerate(rows)), key=str)


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["École", "ÀB", "漢字", "X Y"]
    out = [None, "", " \t\n", "One", "one two", "ONE\vTWO\fthree", "a b c a b c", "\u0000 x y z"]
    for i in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 400))]
        out.append(" ".join(base))
        for _ in range(i % 4):
            near = list(base)
            near[rng.randrange(len(near))] = "other"
            out.append("  ".join(near))
    return out + out[10:14] + [" ".join(rng.choice(words) for _ in range(90_000))]


def test_components_against_all_pairs(spark):
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts())] + [(5, "again"), (5, "words of another text"), (None, "a b c a b c"), (None, "alone here by itself")]
    docs = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, fp string, key int").repartition(5)
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    for most in (512, 2):
        got = pivot_join.near_duplicates(docs, most)
        assert got.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert pivot_join.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [512, 8])
def test_links_connect_what_is_near(spark, most):
    rng = np.random.default_rng(1)
    base = mix(np.arange(1, 300, dtype=np.uint64))
    fps = set(base.tolist()) | {0, (1 << 64) - 1}
    for b in base[:40].tolist():
        for _ in range(30):
            fps.add(b ^ sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(1, 5)).tolist())))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = pivot_join.fingerprint_links(df, most).collect()
    group = {f: f for f in fps}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for a, b in ((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links):
        assert (a ^ b).bit_count() <= 2
        group[root(a)] = root(b)
    want = {r[0]: r[2] for r in plain_components([(f, f) for f in fps])}
    got = {}
    for f in fps:
        got.setdefault(root(f), []).append(f)
    assert {f: min(g) for g in got.values() for f in g} == want


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    at = pivot_join.near_pairs(np.concatenate([fps, near]), np.arange(400), np.arange(400, 800))
    assert at.tolist() == list(range(400))
