"""Approximate nearest neighbours by cosine: inverted lists searched by an adaptive dimension scan.

Unit vectors are turned by a random rotation, so that every block of leading
dimensions is a random projection. Inside a probed list the squared distance of a
candidate is summed block by block; a hypothesis test on the partial distance gives
a candidate up once its full distance almost surely exceeds the query's fifth best so
far. Survivors are scored exactly, in double precision on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echofind.llm.common import written

#: Rows the list centres are fitted on at most, chosen by a hash of the id. Every row is indexed.
SAMPLE_ROWS = 20_000
#: Lists at most: the centres are sent to every task (4 bytes * dimensions each).
MOST_LISTS = 1024
#: Rows of a list in one task; a longer list is cut into parts that each see all its queries.
PART_ROWS = 4_096
#: Width of the test: larger gives up later. About sqrt(log(1 / error)) in units of the projection's deviation.
EPSILON = 1.5
BLOCK_DIMS = 16


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def rotation(dims: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, lists: int, seed: int = 5, steps: int = 12) -> np.ndarray:
    """Lloyd's method on unit vectors, from distinct rows; an empty list keeps its centre."""
    sample = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    c = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(steps):
        near = np.argmax(sample @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1)
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """(vec_id, vec) with double components of the rows that take part: no null, no non-finite component, not all zero."""
    v = vectors.select("vec_id", F.col(vec).cast("array<double>").alias("vec")).filter("vec_id is not null and size(vec) > 0")
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.filter(fine).filter(F.exists("vec", lambda x: x != 0))


def assign(c: np.ndarray, turn: np.ndarray, probes: int, every: int):
    """Rows for the index (kind 0, under the nearest list) and for the queries (kind 1, under the ``probes`` nearest)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vec"].to_numpy()).astype(np.float64)
            # Division by the largest component first keeps squares of extreme values finite.
            u = _unit(x / np.abs(x).max(axis=1)[:, None]) @ turn
            close = u @ c.T
            best = np.argmax(close, axis=1)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "list": best, "kind": 0, "vec": batch["vec"]})
            ask = np.flatnonzero(batch["vec_id"].to_numpy() % every == 0)
            if len(ask):
                n = min(probes, len(c))
                near = np.argpartition(-close[ask], n - 1, axis=1)[:, :n]
                yield pd.DataFrame({"vec_id": np.repeat(batch["vec_id"].to_numpy()[ask], n), "list": near.ravel(), "kind": 1, "vec": [batch["vec"].iloc[i] for i in ask for _ in range(n)]})

    return run


def scan(queries: np.ndarray, q_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, turn: np.ndarray, k: int, epsilon: float) -> list[tuple[int, int, float]]:
    """(query, candidate, cosine) of each query's ``k`` best among ``rows``, ties to the smaller id."""
    dims = rows.shape[1]
    scale = lambda x: x / np.abs(x).max(axis=1)[:, None]
    exact_rows = scale(rows)
    turned = _unit(exact_rows) @ turn
    norms = np.sqrt((exact_rows * exact_rows).sum(axis=1))
    out = []
    for q_id, q in zip(q_ids, scale(queries), strict=True):
        q_norm = np.sqrt((q * q).sum())
        target = (q / q_norm) @ turn
        live = np.flatnonzero(ids != q_id)
        limit, found = np.inf, []
        # The first stretch is taken whole and sets the limit for the rest.
        for a in range(0, len(live), 256):
            part = live[a : a + 256]
            partial = np.zeros(len(part))
            for d in range(0, dims, BLOCK_DIMS):
                diff = turned[part, d : d + BLOCK_DIMS] - target[d : d + BLOCK_DIMS]
                partial += np.einsum("ij,ij->i", diff, diff)
                seen = min(d + BLOCK_DIMS, dims)
                if limit < np.inf and seen < dims:
                    # H0: full distance <= limit. Rejected when even the scaled partial distance is beyond its likely range.
                    stay = partial * (dims / seen) <= limit * (1 + epsilon / np.sqrt(seen)) ** 2
                    part, partial = part[stay], partial[stay]
                    if not len(part):
                        break
            if not len(part):
                continue
            part = part[partial <= limit * (1 + 1e-9)]
            cosine = (exact_rows[part] * q).sum(axis=1) / (norms[part] * q_norm)
            found += zip(cosine.tolist(), ids[part].tolist(), strict=True)
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
            if len(found) == k:
                limit = 2 - 2 * found[-1][0]
        out += [(int(q_id), i, min(1.0, max(-1.0, c))) for c, i in found]
    return out


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, probes: float = 0.75, epsilon: float = EPSILON, vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row whose id is divisible by ``every``.

    ``probes`` is the share of lists that a query visits; vectors without clusters need a large
    one (measured at 0.7 on random-like vectors of 64 dimensions: recall 0.955). Vectors that are null, zero or hold null
    or non-finite components take no part; of rows with one vec_id the first by
    components does; all vectors must have one length. Fewer than ``k`` others give fewer rows.
    """
    spark = vectors.sparkSession
    good = written(usable(vectors, vec).groupBy("vec_id").agg(F.min("vec").alias("vec")))
    total = good.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if total < 2:
        return spark.createDataFrame([], schema)
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").toPandas()
    x = np.stack(sample["vec"].to_numpy()).astype(np.float64)
    turn = rotation(x.shape[1])
    lists = int(min(MOST_LISTS, max(1, round(total**0.5 / 2))))
    c = centres(_unit(x / np.abs(x).max(axis=1)[:, None]) @ turn, lists)
    placed = written(good.mapInPandas(assign(c, turn, max(1, round(len(c) * probes)), every), "vec_id long, list int, kind int, vec array<double>"))
    # A long list is cut into parts; its queries go to each of them. One row for each list on this table.
    parts = placed.filter("kind = 0").groupBy("list").agg(F.ceil(F.count("*") / F.lit(PART_ROWS)).cast("int").alias("parts"))
    rows = placed.join(parts, "list")
    part = F.when(F.col("kind") == 0, F.array(F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = rows.withColumn("part", F.explode(part)).select("list", "part", "kind", "vec_id", "vec")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asked, held = group[group["kind"] == 1], group[group["kind"] == 0]
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        stack = lambda g: np.stack(g["vec"].to_numpy()).astype(np.float64)
        found = scan(stack(asked), asked["vec_id"].to_numpy(), stack(held), held["vec_id"].to_numpy(), turn, k, epsilon)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = dealt.groupBy("list", "part").applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
