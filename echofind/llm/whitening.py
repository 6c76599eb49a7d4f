"""Whitening of embeddings from the singular values of the centred rows, without a covariance matrix.

1. Blockwise QR: every task folds its centred rows, block by block, into one upper
   triangular factor, and a tree of tasks folds those factors into a single R.
2. Householder reflections from both sides make R bidiagonal.
3. dqds finds the squares of the bidiagonal's singular values to high relative accuracy.
4. For each of the leading ones, a twisted factorisation gives the vector of the
   bidiagonal, and the right reflections turn it into a whitening direction.

R and what follows from it have the size of one row squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import written
from echofind.llm.vectors import integer_vectors

SCALE, OFFSET = 1024, 100_000
#: Larger scaled components count as this; sums of them are exact for 2**23 rows in 64 bits and beyond that by decimals.
BOUND = 1 << 40
COMPONENTS = 8
#: Rows folded into a factor at a time.
BLOCK_ROWS = 1024
#: States folded by one task of a tree.
FAN = 64
EPS = float(np.finfo(np.float64).eps)

State = np.ndarray


def folded(parts: DataFrame, fold: Callable[[list[State]], State]) -> State | None:
    """One state of all ``parts`` (part, state), folded in a tree of tasks; the driver gets ``FAN`` states at most."""

    def step(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        return pd.DataFrame({"part": [int(group["part"].min()) // FAN], "state": [fold([np.frombuffer(s) for s in group["state"]]).tobytes()]})

    parts = written(parts)
    while parts.count() > FAN:
        parts = written(parts.groupBy(F.floor(F.col("part") / FAN).alias("_group")).applyInPandas(step, "part long, state binary"))
    states = [np.frombuffer(r["state"]) for r in parts.orderBy("part").collect()]
    return fold(states) if states else None


def _states(mapped: Callable[[np.ndarray, State | None], State], column: str):
    """Each task's rows, stacked block by block, as one state."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for batch in batches:
            for a in range(0, len(batch), BLOCK_ROWS):
                state = mapped(np.stack(batch[column].iloc[a : a + BLOCK_ROWS].to_numpy()), state)
        if state is not None:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [state.tobytes()]})

    return run


def triangle(rows: np.ndarray) -> np.ndarray:
    """The square upper triangular factor of ``rows``."""
    r = np.linalg.qr(rows, mode="r")
    out = np.zeros((rows.shape[1], rows.shape[1]))
    out[: len(r)] = r
    return out


def centred_factor(rows: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of all centred rows (x): R'R is n times their covariance."""
    d = len(mean)

    def add(x: np.ndarray, state: State | None) -> State:
        y = x - mean
        return triangle(y if state is None else np.concatenate([state, y]))

    def fold(states: list[State]) -> State:
        out = states[0].reshape(d, d)
        for s in states[1:]:
            out = triangle(np.concatenate([out, s.reshape(d, d)]))
        return out

    return folded(rows.select("x").mapInPandas(_states(add, "x"), "part long, state binary"), fold)


def _reflector(x: np.ndarray) -> np.ndarray:
    """The unit vector u for which (I - 2uu') turns x into a multiple of the first axis; zero if x needs none."""
    largest = np.abs(x).max(initial=0.0)
    if not largest or len(x) == 1:
        return np.zeros_like(x)
    u = x / largest
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' for orthogonal U and V."""
    a, d = r.astype(np.float64), len(r)
    v = np.eye(d)
    for k in range(d):
        u = _reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            u = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float] | None:
    """One differential qd step with a shift: (q, e, least d, last d); None if the shift was too large inside."""
    d = q[0] - shift
    least = d
    out_q, out_e = [], []
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        if total:
            t = q[k + 1] / total
            out_e.append(e[k] * t)
            d = d * t - shift
        else:
            out_e.append(0.0)
            d = q[k + 1] - shift
        out_q.append(total)
        least = min(least, d)
    return [*out_q, d], out_e, least, d


def dqds(diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal matrix, falling, each to high relative accuracy."""
    small = (64 * EPS) ** 2
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in beside], 0.0)]
    out = []
    while todo:
        q, e, taken = todo.pop()
        for _ in range(60 * len(q) + 60):
            while q and (len(q) == 1 or e[-1] <= small * (taken + q[-1])):
                out.append(taken + max(q.pop(), 0.0))
                if e:
                    e.pop()
            if not q:
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (taken + min(q[i], q[i + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], taken))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            # The lesser eigenvalue of the last two rows is no less than the least of all.
            top, low, side = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            shift = low - side / (max((top - low) / 2, 0.0) + np.hypot((top - low) / 2, np.sqrt(side)) + 1e-300)
            shift = float(max(0.0, min(shift, min(q))))
            for attempt in range(5):
                step = _transform(q, e, shift)
                if step is not None and step[2] >= 0:
                    break
                # A step that fails at its very end tells by how much the shift was too large.
                shift = max(0.0, shift + step[3]) * (1 - 4 * EPS) if step is not None and attempt == 0 else shift / 4
            else:
                shift, step = 0.0, _transform(q, e, 0.0)
            q, e = step[0], step[1]
            taken += shift
        else:
            raise ArithmeticError("dqds has not converged")
    return np.sort(np.array(out))[::-1]


def _safe(x: float) -> float:
    return x if abs(x) > 1e-290 else 1e-290


def twisted(diagonal: np.ndarray, beside: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """Twisted factorisations of B'B - value * I: (gammas, vectors); row k is the vector of the twist at k, its k-th entry 1."""
    n = len(diagonal)
    tiny = EPS * EPS * max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0), 1e-150)
    a = np.where(np.abs(diagonal) > tiny, diagonal, tiny)
    pivot, low = a * a, beside / a[:-1]
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = pivot[i] * low[i] / _safe(s[i] + pivot[i])
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[-1] = pivot[-1] - value
    for i in range(n - 2, -1, -1):
        t = pivot[i] / _safe(pivot[i] * low[i] * low[i] + p[i + 1])
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    vectors = np.eye(n)
    for k in range(n):
        for i in range(k - 1, -1, -1):
            vectors[k, i] = -down[i] * vectors[k, i + 1]
        for i in range(k, n - 1):
            vectors[k, i + 1] = -up[i] * vectors[k, i]
    return s + p + value, vectors


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values of r and their right singular vectors (as columns), as far as they are above rounding."""
    scale = np.abs(r).max(initial=0.0)
    if not scale:
        return np.zeros(0), np.zeros((len(r), 0))
    a, b, v = bidiagonal(r / scale)
    values = dqds(a, b)
    values = values[: min(count, int((values > (len(r) * EPS) ** 2 * values[0]).sum()))]
    # Where the superdiagonal is negligible the matrix falls into blocks.
    edges = np.concatenate([[0], np.flatnonzero(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))) + 1, [len(a)]])
    found: list[np.ndarray] = []
    for value in values:
        best, weight = None, -1.0
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            lam = value
            for _ in range(2):
                gamma, z = twisted(a[low:high], b[low : high - 1], lam)
                with np.errstate(over="ignore"):  # twists at places without weight grow beyond all bounds and are passed over
                    norm = np.sqrt((z * z).sum(axis=1))
                k = int(np.argmin(np.abs(gamma) / norm))
                # The Rayleigh correction stays within the accuracy of dqds.
                lam += float(np.clip(gamma[k] / norm[k] ** 2, -1e-12 * value, 1e-12 * value))
            order = np.argsort(np.abs(gamma) / norm)[:8]
            for k in order:
                if not np.isfinite(norm[k]) or abs(gamma[k]) / norm[k] > 1e-8 * values[0]:
                    continue
                x = np.zeros(len(a))
                x[low:high] = z[k] / norm[k]
                for _ in range(2):
                    for y in found:
                        x -= (x @ y) * y
                left = np.linalg.norm(x)
                if left > weight:
                    best, weight = x / max(left, 1e-300), left
                if weight > 0.5:
                    break
            if weight > 0.5:
                break
        if best is None or weight < 1e-3:
            raise ArithmeticError("no vector was found for a singular value")
        found.append(best)
    return values * scale * scale, v @ np.array(found).T


def _whiten(n: int, sums: list[int], fits: bool, axes: np.ndarray, values: np.ndarray, count: int):
    mean = np.array([s / n for s in sums])
    exact = np.array(sums, np.int64 if fits else object)
    # Singular values are of all rows; their squares over n are the variances.
    scales = 1 / np.sqrt(values / n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["x"].to_numpy())
            gap = (x if fits else x.astype(object)) * n - exact
            deviation = (gap * gap).sum(axis=1)
            if not fits:
                deviation = pd.array([d if d < 1 << 63 else None for d in deviation], "Int64")
            white = ((x - mean) @ axes) * scales
            rows = [[*w, *[None] * (count - len(w))] for w in white.tolist()]
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "deviation": deviation, "white": rows})

    return run


def identity_error(white: DataFrame, count: int) -> float:
    """The largest entry of the covariance of ``white`` (arrays of at least ``count`` numbers) less the identity, in size."""

    def merge(s: State, t: State) -> State:
        """States are n, the means and the centred products."""
        n, m = s[0], t[0]
        gap = t[1 : count + 1] - s[1 : count + 1]
        products = s[count + 1 :] + t[count + 1 :] + np.outer(gap, gap).ravel() * (n * m / (n + m))
        return np.concatenate([[n + m], s[1 : count + 1] + gap * (m / (n + m)), products])

    def add(w: np.ndarray, state: State | None) -> State:
        w = np.array([x[:count] for x in w], np.float64)
        mean = w.mean(axis=0)
        new = np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()])
        return new if state is None else merge(state, new)

    def fold(states: list[State]) -> State:
        out = states[0]
        for s in states[1:]:
            out = merge(out, s)
        return out

    state = folded(white.select("white").mapInPandas(_states(add, "white"), "part long, state binary"), fold)
    return float(np.abs(state[count + 1 :].reshape(count, count) / state[0] - np.eye(count)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, ``components`` rows for each vector that takes part.

    Fewer dimensions give fewer components. Rows whose vector is null, empty, or holds null or non-finite entries are
    left out, and so are those of another length than most vectors have. Repeated rows and
    rows without vec_id are kept. A component without variance has no direction: its
    ``whitened`` is null and its ``explained`` 0 (null where nothing varies), and it
    is no part of ``identity_error`` (null if no component varies). A
    ``deviation`` beyond 64 bits is null. Equal variances are numbered in any order. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows, d = integer_vectors(vectors, SCALE, OFFSET, BOUND, vec=vec)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return spark.createDataFrame([], schema)
    # One row for each dimension.
    total = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("at").collect()
    n, sums = total[0]["n"], [int(r["s"]) for r in total]
    reach = max(r["high"] - r["low"] for r in total)
    largest = max(max(abs(r["low"]), abs(r["high"])) for r in total)
    fits = n * largest < 1 << 62 and d * (n * reach) ** 2 < 1 << 63
    factor = centred_factor(rows, np.array([s / n for s in sums]))
    values, axes = directions(factor, components)
    found, shown = len(values), min(components, d)
    white = written(rows.mapInPandas(_whiten(n, sums, fits, axes, values, shown), "vec_id long, deviation long, white array<double>"))
    error = identity_error(white, found) if found else None
    trace = float((factor * factor).sum())
    shares = [float(v) / trace for v in values] + [0.0 if trace else None] * (shown - found)
    share = F.array(*(F.lit(s).cast("double") for s in shares))
    out = white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
