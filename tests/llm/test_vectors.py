"""Whitening and vector codes against plain numpy and Python."""

import hashlib
import math

import numpy as np
import pytest

from echofind.llm import grid_codes, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, n long, code string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, "x") for i, v, label in rows], SCHEMA)


def hostile(n, d, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.2, d).tolist(), int(i) % 3) for i in rng.permutation(n)]
    rows += [(rows[0][0], rows[0][1], None), (9001, rows[1][1], None), (9002, [0.0] * d, 1)]
    bad = [(9100, None, 1), (9101, [math.nan] * d, 1), (9102, [math.inf, *[0.0] * (d - 1)], 2), (9103, [None, *[0.0] * (d - 1)], 2), (9104, [], 2), (9105, [0.1] * (d + 1), 2)]
    return rows, bad


@pytest.mark.parametrize("kind", ["random", "graded", "low rank", "one column", "diagonal", "zero", "equal"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(3)
    d = 24
    m = {
        "random": rng.normal(size=(300, d)),
        "graded": rng.normal(size=(300, d)) * np.logspace(0, -12, d),
        "low rank": rng.normal(size=(300, 5)) @ rng.normal(size=(5, d)),
        "one column": np.eye(1, d) * rng.normal(size=(300, 1)),
        "diagonal": np.diag(np.arange(1.0, d + 1)),
        "zero": np.zeros((3, d)),
        "equal": np.linalg.qr(rng.normal(size=(300, d)))[0],
    }[kind]
    r = whitening.triangle(m)
    a, b, v = whitening.bidiagonal(r)
    truth = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.allclose(whitening.dqds(a, b)[: len(truth)], truth, rtol=1e-12, atol=1e-13 * max(truth.max(), 1e-300))
    values, axes = whitening.directions(r, 8)
    assert len(values) == min(8, int((truth > 1e-20 * truth.max()).sum()) if truth.max() else 0)
    if len(values):
        assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
        assert np.abs(m.T @ (m @ axes) - axes * values).max() < 1e-11 * truth.max()


def test_graded_values_keep_their_digits():
    a = np.logspace(0, -14, 12)
    got = whitening.dqds(a, 0.5 * a[1:])
    from decimal import Decimal, getcontext

    # Sturm counts of B'B in 60 digits.
    getcontext().prec = 60
    q, e = [Decimal(x) ** 2 for x in a.tolist()], [Decimal(x) ** 2 for x in (0.5 * a[1:]).tolist()]

    def below(x):
        count, d = 0, q[0] - x
        count += d < 0
        for k in range(len(e)):
            d = q[k + 1] + e[k] - x - q[k] * e[k] / d
            count += d < 0
        return count

    for i, v in enumerate(got[::-1].tolist()):
        assert below(Decimal(v) * (1 + Decimal("1e-13"))) >= i + 1 and below(Decimal(v) * (1 - Decimal("1e-13"))) <= i


def test_whitening_against_numpy(spark):
    rows, bad = hostile(400, 12, 5)
    got = whitening.whiten(table(spark, rows + bad).repartition(7)).collect()
    x = np.floor(1024 * np.array([v for _, v, _ in rows])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 8 * n and {r["n"] for r in got} == {n}
    white = y @ axes[:, :8] / np.sqrt(values[:8])
    sign = {}
    want = sorted((i, int(((n * r - s) ** 2).sum()), w.tolist()) for (i, _, _), r, w in zip(rows, x, white, strict=True))
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    for i, deviation, w in want:
        for r in by[i, deviation]:
            k = r["component"] - 1
            sign.setdefault(k, np.sign(r["whitened"] * w[k]))
            assert abs(r["whitened"] * sign[k] - w[k]) < 1e-9
            assert abs(r["explained"] - values[k] / np.trace(cov)) < 1e-12 and r["identity_error"] < 1e-9
    assert sum(len(v) for v in by.values()) == len(got)


def test_whitening_of_few_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None, 1)])).count() == 0
    one = whitening.whiten(table(spark, [(1, [0.5, 0.25], 1)])).orderBy("component").collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None), (2, 0, None, None, None)]
    two = whitening.whiten(table(spark, [(1, [1.0, 2.0], 1), (None, [3.0, 2.0], 1)])).orderBy("component", "whitened").collect()
    assert [(r["component"], r["whitened"] and round(r["whitened"], 9), r["explained"]) for r in two] == [(1, -1.0, 1.0), (1, 1.0, 1.0), (2, None, 0.0), (2, None, 0.0)]
    huge = whitening.whiten(table(spark, [(1, [1e300, 0.0], 1), (2, [-1e300, 1.0], 1)])).collect()
    assert all(r["deviation"] is None for r in huge) and len(huge) == 4


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0], r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(f[0] for f in found)
        sums[label] = sums.get(label, 0) + error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i, code, error, sums[label], digest) for i, code, error, label in out)


@pytest.mark.parametrize("n,d", [(300, 32), (40, 16)])
def test_codes_against_plain_python(spark, n, d):
    rows, bad = hostile(n, d, 8)
    got = grid_codes.compress(table(spark, rows + bad).repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == plain_codes(rows)


def test_grid_against_all_entries():
    rng = np.random.default_rng(2)
    for scale in (1, 5, 400):
        entries = rng.integers(-scale, scale + 1, (64, 4))
        points = rng.integers(-2 * scale, 2 * scale + 1, (5000, 4))
        grid = grid_codes.Grid(entries)
        d = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        for _ in range(2):  # from the memo the second time
            entry, distance = grid.nearest(points)
            assert (entry == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()


def test_codes_of_few_rows(spark):
    assert grid_codes.compress(table(spark, [])).count() == 0
    odd = grid_codes.compress(table(spark, [(1, [0.5, 0.25, 0.125], None), (2, [1e300, -1e300, 0.0], 4)])).orderBy("vec_id").collect()
    assert [r["error"] for r in odd] == [0, 0] and odd[0]["code"] == "00" * 16 and odd[1]["code"][:4] == "0101"
