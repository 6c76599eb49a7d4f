"""Work on pairs in tiles: what a document contributes is shipped once for each tile, not once for each pair.

The documents of a cluster of pairs mostly share their least partner. Pairs are dealt out by
that hub, so a cluster meets in one tile and each of its documents travels once. A hub of many
pairs is cut into a square of tiles by hashes of both ids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from echofind.operators.joins import join_lookup
from echofind.sources.store import stored

#: Pairs of a tile, on average.
TILE_PAIRS = 4_000
#: Pairs that one task sorts, on average; more pairs make more tasks.
TASK_PAIRS = 500_000
#: The same where whole texts travel.
TEXT_TILE_PAIRS, TEXT_TASK_PAIRS = 250, 5_000
#: Pairs of a cell of a grid, on average, and documents of either side that it holds at most, on average.
CELL_PAIRS, CELL_SIDE = 1_000_000, 32_000
#: Pairs for which a cell of its own is worth while, so that all tasks have work.
LEAST_CELL = 32_000
#: Words of a dense piece of a product of matrices.
BLOCK_WORDS = 2_048

Kernel = Callable[[np.ndarray, np.ndarray, pd.DataFrame], dict[str, np.ndarray]]


def _dealt(pairs: DataFrame, payload: DataFrame, id_col: str, tile_pairs: int, task_pairs: int) -> tuple[DataFrame, DataFrame]:
    """``pairs``, which is a stored table, with ``_tile``, and the rows of ``payload`` that each tile ``_at`` needs; both partitioned by tile."""
    hubs = pairs.groupBy("id2").agg(F.min("id1").alias("least")).select(F.col("id2").alias("id1"), "least")
    led = join_lookup(pairs, hubs, ["id1"], "left").withColumn("_hub", F.least("id1", F.coalesce("least", "id1"))).drop("least")
    sizes = led.groupBy("_hub").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / F.lit(float(tile_pairs)))).alias("_side"))
    sized = join_lookup(led, sizes, ["_hub"])
    places = [F.pmod(F.xxhash64(c), F.col("_side")) for c in ("id1", "id2")]
    total = pairs.count()
    tiles = max(1, -(-total // tile_pairs))
    placed = stored(sized.withColumn("_tile", F.pmod(F.xxhash64("_hub", *places), F.lit(tiles))).select(*pairs.columns, "_tile"))
    needed = placed.select(F.col("_tile").alias("_at"), F.explode(F.array("id1", "id2")).alias(id_col)).distinct()
    shipped = join_lookup(needed, payload, [id_col])
    parts = _tasks(pairs, tiles, total, task_pairs)
    return placed.repartition(parts, "_tile"), shipped.repartition(parts, "_at")


def in_tiles(pairs: DataFrame, payload: DataFrame, kernel: Kernel, results: tuple[str, ...], id_col: str = "doc_id", tile_pairs: int = TILE_PAIRS) -> DataFrame:
    """``pairs`` (id1, id2, ...) with the bigint ``results`` of ``kernel``.

    ``kernel`` takes the places of both sides in a table of the tile's documents and
    that table, the columns of ``payload`` (one row for each id). Pairs of an id that
    ``payload`` lacks are left out. The pairs are stored first.
    """
    pairs = stored(pairs)
    placed, shipped = _dealt(pairs, payload, id_col, tile_pairs, TASK_PAIRS)
    schema = StructType([*pairs.schema.fields, *(StructField(name, LongType()) for name in results)])
    columns = pairs.columns

    def work(left: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values(id_col).reset_index(drop=True)
        ids = docs[id_col].to_numpy()
        sides = []
        for side in ("id1", "id2"):
            at = np.minimum(np.searchsorted(ids, left[side].to_numpy()), max(0, len(ids) - 1))
            sides.append((at, ids[at] == left[side].to_numpy() if len(ids) else np.zeros(len(left), bool)))
        known = sides[0][1] & sides[1][1]
        left = left.loc[known, columns]
        if not len(left):
            return pd.DataFrame({name: [] for name in (*columns, *results)})
        return left.assign(**kernel(sides[0][0][known], sides[1][0][known], docs))

    return placed.groupBy("_tile").cogroup(shipped.groupBy("_at")).applyInPandas(work, schema)


def texts_in_tiles(pairs: DataFrame, texts: DataFrame, id_col: str = "doc_id", tile_pairs: int = TEXT_TILE_PAIRS) -> DataFrame:
    """``(id1, id2, text1, text2)`` of ``pairs`` from ``texts`` (id, text).

    A text is shuffled once for each tile, and the pairs of texts come into being where the
    tile is. As in a join, an id with several rows gives one pair for each. The pairs are stored first.
    """
    pairs = stored(pairs.select("id1", "id2").where("id1 is not null and id2 is not null"))
    placed, shipped = _dealt(pairs, texts.select(F.col(id_col).alias("_id"), "text"), "_id", tile_pairs, TEXT_TASK_PAIRS)
    schema = StructType([*pairs.schema.fields, *(StructField(c, StringType()) for c in ("text1", "text2"))])

    def work(left: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        for side in ("1", "2"):
            left = left.merge(docs.rename(columns={"_id": f"id{side}", "text": f"text{side}"}).drop(columns="_at"), on=f"id{side}")
        return left[["id1", "id2", "text1", "text2"]]

    return placed.groupBy("_tile").cogroup(shipped.groupBy("_at")).applyInPandas(work, schema)


def _slots(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _tasks(pairs: DataFrame, tiles: int, total: int, task_pairs: int = 0) -> int:
    """How many tasks work on ``total`` pairs in ``tiles``.

    A few bytes of pairs may be much work, so the tiles are not left to be merged by size.
    """
    return min(tiles, max(_slots(pairs), -(-total // (task_pairs or TASK_PAIRS))))


def in_grid(
    pairs: DataFrame,
    left: DataFrame,
    right: DataFrame,
    kernel: Kernel,
    results: tuple[str, ...],
    left_id: str = "probe_id",
    right_id: str = "doc_id",
    cell_pairs: int = CELL_PAIRS,
    cell_side: int = CELL_SIDE,
) -> DataFrame:
    """``pairs`` (left_id, right_id) of two tables with the bigint ``results`` of ``kernel``.

    Both sides are dealt out by hashes of their ids, and a cell of the grid gets each
    document that it needs once. Cells are as large as their pairs and the number of tasks allow, so the
    denser the pairs are the less often a document travels. An id that a table holds
    several times is judged with each row; pairs of an id that it lacks are left out. ``left`` and
    ``right`` share their other columns. The pairs are stored first.
    """
    pairs = stored(pairs.select(left_id, right_id))
    total, n_left, n_right = pairs.agg(F.count(F.lit(1)), F.approx_count_distinct(left_id), F.approx_count_distinct(right_id)).first()
    held = min(cell_pairs, max(LEAST_CELL, total // _slots(pairs)))
    side = max(1, min(cell_side, int((held * n_left * n_right / max(1, total)) ** 0.5)))
    rows, columns = max(1, -(-n_left // side)), max(1, -(-n_right // side))
    places = F.pmod(F.xxhash64(left_id), F.lit(rows)) * F.lit(columns) + F.pmod(F.xxhash64(right_id), F.lit(columns))
    placed = pairs.withColumn("_cell", places)
    payload = [c for c in left.columns if c != left_id]

    def needed(table: DataFrame, key: str, second: bool) -> DataFrame:
        wanted = placed.select(F.col("_cell").alias("_at"), F.col(key).alias("_id")).distinct()
        return join_lookup(wanted, table.select(F.col(key).alias("_id"), *payload), ["_id"]).withColumn("_second", F.lit(second))

    shipped = needed(left, left_id, False).unionByName(needed(right, right_id, True))
    schema = StructType([*pairs.schema.fields, *(StructField(name, LongType()) for name in results)])

    def work(met: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        docs = docs.reset_index(drop=True)
        second = docs["_second"].to_numpy(bool)
        met = met.drop(columns="_cell")
        for key, place, own in ((left_id, "_x", ~second), (right_id, "_y", second)):
            met = met.merge(pd.DataFrame({key: docs["_id"].to_numpy()[own], place: np.flatnonzero(own)}), on=key)
        if not len(met):
            return pd.DataFrame({name: [] for name in (left_id, right_id, *results)})
        return met[[left_id, right_id]].assign(**kernel(met["_x"].to_numpy(), met["_y"].to_numpy(), docs))

    parts = _tasks(pairs, rows * columns, total)
    placed, shipped = placed.repartition(parts, "_cell"), shipped.repartition(parts, "_at")
    return placed.groupBy("_cell").cogroup(shipped.groupBy("_at")).applyInPandas(work, schema)


@dataclass(frozen=True)
class Vectors:
    """Sparse vectors: document i has the places ``code`` and the ``count`` from ``edge[i]`` to ``edge[i + 1]``."""

    edge: np.ndarray
    code: np.ndarray
    count: np.ndarray
    squared: np.ndarray
    width: int


def vectors(docs: pd.DataFrame) -> Vectors:
    """The vectors given as ``names`` and ``counts`` (null: all one)."""
    size = np.array([len(n) for n in docs["names"]], np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate([np.asarray(n, np.int64) for n in docs["names"]]) if edge[-1] else np.zeros(0, np.int64)
    ones = docs["counts"].isna().all()
    count = np.ones(len(flat), np.int64) if ones or not edge[-1] else np.concatenate([np.asarray(c, np.int64) for c in docs["counts"]])
    values, code = np.unique(flat, return_inverse=True)
    summed = np.concatenate([[0], np.cumsum(count * count)])
    return Vectors(edge, code, count, summed[edge[1:]] - summed[edge[:-1]], len(values))


def dot_products(x: np.ndarray, y: np.ndarray, docs: pd.DataFrame, found: Vectors | None = None) -> dict[str, np.ndarray]:
    """``dot``, ``squared1`` and ``squared2`` of sparse vectors, given as ``names`` and ``counts`` (null: all one)."""
    found = found or vectors(docs)
    edge, code, count, squared = found.edge, found.code, found.count, found.squared
    dense = np.zeros(found.width, np.int64)
    dot = np.zeros(len(x), np.int64)
    order = np.argsort(x, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], x[order][1:] != x[order][:-1], [True]])) if len(x) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = order[a:b]
        own = slice(edge[x[at[0]]], edge[x[at[0]] + 1])
        dense[code[own]] = count[own]
        for i in at.tolist():
            other = slice(edge[y[i]], edge[y[i] + 1])
            dot[i] = dense[code[other]] @ count[other]
        dense[code[own]] = 0
    return {"dot": dot, "squared1": squared[x], "squared2": squared[y]}


def block_products(a: np.ndarray, b: np.ndarray, found: Vectors) -> np.ndarray:
    """The dot product of each document of ``a`` with each of ``b``, from dense pieces of the words that both sides have.

    Counts are not negative, so no part of a sum is larger than the longest vectors' product: below
    2^24 single precision is exact, below 2^53 double precision.
    """
    bound = float(np.sqrt(found.squared[a].max(initial=0)) * np.sqrt(found.squared[b].max(initial=0)))
    kind = np.float32 if bound < 2**24 - 1 else np.float64 if bound < 2**52 else np.int64
    rows, places, counts, has = [], [], [], []
    for side in (a, b):
        size = found.edge[side + 1] - found.edge[side]
        at = np.repeat(found.edge[side] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rows.append(np.repeat(np.arange(len(side)), size))
        places.append(found.code[at])
        counts.append(found.count[at])
        seen = np.zeros(found.width, bool)
        seen[places[-1]] = True
        has.append(seen)
    both = has[0] & has[1]
    column = np.cumsum(both) - 1
    shared = int(both.sum())
    for i in range(2):
        kept = both[places[i]]
        order = np.argsort(column[places[i][kept]], kind="stable")
        rows[i], counts[i], places[i] = rows[i][kept][order], counts[i][kept][order], column[places[i][kept]][order]
    result = np.zeros((len(a), len(b)), kind)
    for first in range(0, shared, BLOCK_WORDS):
        dense = []
        for side, row, place, count in zip((a, b), rows, places, counts):
            low, high = np.searchsorted(place, (first, first + BLOCK_WORDS))
            piece = np.zeros((len(side), min(BLOCK_WORDS, shared - first)), kind)
            piece[row[low:high], place[low:high] - first] = count[low:high]
            dense.append(piece)
        result += dense[0] @ dense[1].T
    return result.astype(np.int64)


def equal_positions(x: np.ndarray, y: np.ndarray, docs: pd.DataFrame) -> dict[str, np.ndarray]:
    """``equal`` positions of MinHash signatures of ``length``, and the ``distance`` of SimHash signatures; -1 where one is missing."""
    present = docs["minhash"].notna().to_numpy()
    lengths = {len(m) for m in docs.loc[present, "minhash"]}
    if len(lengths) > 1:
        raise ValueError("signatures have to be of one length to be compared")
    table = np.zeros((len(docs), lengths.pop() if lengths else 0), np.int64)
    if present.any():
        table[present] = np.stack(docs.loc[present, "minhash"].to_numpy())
    equal = np.concatenate([(table[x[a : a + 4096]] == table[y[a : a + 4096]]).sum(axis=1) for a in range(0, len(x), 4096)])
    bits = docs["simhash"]
    known = bits.notna().to_numpy()
    value = bits.astype("Int64").fillna(0).to_numpy(np.int64).view(np.uint64)
    distance = np.bitwise_count(value[x] ^ value[y]).astype(np.int64)
    return {"equal": np.where(present[x] & present[y], equal, -1), "length": np.full(len(x), table.shape[1]), "distance": np.where(known[x] & known[y], distance, -1)}
