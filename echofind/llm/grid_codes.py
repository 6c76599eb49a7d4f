"""Product codes of vectors; the nearest codebook entry is looked up in memoised grid cells.

A vector is cut into parts, each with its own codebook. A part falls into a coarse cell of a
grid. For a cell's box every entry has a least and a greatest distance; an entry whose least
distance exceeds another's greatest is never nearest in that box. The entries that stay
are remembered under the hash of the cell, and only they are evaluated exactly for
the parts inside it. All numbers are integers, so every distance is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import mix, written
from echofind.llm.vectors import integer_vectors

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Cells that a grid remembers before it starts anew, of at most ENTRIES bytes each.
MEMO_CELLS = 20_000
#: Distances evaluated at a time, times the width of a part.
CHUNK = 1 << 20
#: Distinct labels whose sums are joined by a broadcast; more are joined by a shuffle.
FEW_LABELS = 100_000


class Grid:
    """Nearest entries of one codebook, ties to the lower index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        spread = np.abs(self.entries - np.floor(self.entries.mean(axis=0)).astype(np.int64)).mean() if len(entries) else 0
        #: Cells are 2**shift wide, about half the mean deviation of the entries.
        self.shift = max(0, int(spread / 2).bit_length() - 1)
        self.memo: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell, the entries that are nearest somewhere in its box or may be."""
        out = []
        step = max(1, CHUNK // max(1, self.entries.size))
        for a in range(0, len(cells), step):
            low = (cells[a : a + step] << self.shift)[:, None]
            high = low + (1 << self.shift) - 1
            e = self.entries[None]
            outside = np.maximum(np.maximum(low - e, e - high), 0)
            across = np.maximum(np.abs(e - low), np.abs(e - high))
            keep = (outside * outside).sum(axis=2) <= (across * across).sum(axis=2).min(axis=1, keepdims=True)
            out += [np.flatnonzero(k).astype(np.uint8 if len(self.entries) <= 256 else np.int32) for k in keep]
        return out

    def candidates(self, parts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The cell of each part, as a place in the returned lists of entries."""
        cells = parts >> self.shift
        weight = mix(np.arange(1, cells.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
        name = mix((cells.view(np.uint64) * weight).sum(axis=1, dtype=np.uint64))
        keys, first, of = np.unique(name, return_index=True, return_inverse=True)
        # Different cells of one hash, should they ever occur, are told apart by their coordinates.
        if (cells != cells[first][of]).any():
            _, first, of = np.unique(cells, axis=0, return_index=True, return_inverse=True)
            return of, self.undominated(cells[first])
        if len(self.memo) > MEMO_CELLS:
            self.memo.clear()
        found = [self.memo.get(k) for k in keys.tolist()]
        new = [i for i, f in enumerate(found) if f is None or (f[0] != cells[first[i]]).any()]
        for i, kept in zip(new, self.undominated(cells[first[new]]), strict=True):
            found[i] = self.memo[int(keys[i])] = (cells[first[i]].copy(), kept)
        return of, [f[1] for f in found]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part."""
        entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        step = max(1, CHUNK // max(1, self.entries.size))
        for a in range(0, len(parts), step):
            part = np.ascontiguousarray(parts[a : a + step])
            of, kept = self.candidates(part)
            size = np.array([len(k) for k in kept])
            base = np.cumsum(size) - size
            flat = np.concatenate(kept).astype(np.int64)
            n = size[of]
            start = np.cumsum(n) - n
            tried = flat[np.repeat(base[of] - start, n) + np.arange(n.sum())]
            gap = np.repeat(part, n, axis=0) - self.entries[tried]
            d = (gap * gap).sum(axis=1)
            least = np.minimum.reduceat(d, start)
            # Entries are tried in rising order, so the first that is as near wins.
            equal = np.flatnonzero(d == np.repeat(least, n))
            owner = np.repeat(np.arange(len(part)), n)[equal]
            fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
            entry[a : a + step], distance[a : a + step] = tried[equal[fresh]], least
        return entry, distance


def _parts(batch: pd.DataFrame, width: int) -> np.ndarray:
    """(part, row, component) of a batch; components short of PARTS * width are zeros."""
    x = np.stack(batch["x"].to_numpy()).astype(np.int64)
    out = np.zeros((len(x), PARTS * width), np.int64)
    out[:, : x.shape[1]] = x
    return out.reshape(len(x), PARTS, width).transpose(1, 0, 2)


def _gather(books: np.ndarray):
    """Sums and counts of the parts assigned to each entry, one row for each entry and task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        grids = [Grid(b) for b in books]
        for batch in batches:
            if len(batch):
                for p, rows in enumerate(_parts(batch, books.shape[2])):
                    entry, _ = grids[p].nearest(rows)
                    np.add.at(sums[p], entry, rows)
                    counts[p] += np.bincount(entry, minlength=books.shape[1])
        p, e = np.nonzero(counts)
        if len(p):
            yield pd.DataFrame({"part": p.astype(np.int32), "entry": e.astype(np.int32), "n": counts[p, e], "sums": list(sums[p, e])})

    return run


def _encode(books: np.ndarray, keep: tuple[str, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grids = [Grid(b) for b in books]
        for batch in batches:
            if not len(batch):
                continue
            code, error = np.zeros((len(batch), PARTS), np.uint8), np.zeros(len(batch), np.int64)
            for p, rows in enumerate(_parts(batch, books.shape[2])):
                entry, distance = grids[p].nearest(rows)
                code[:, p] = entry
                error += distance
            yield batch[list(keep)].assign(code=[c.tobytes().hex() for c in code], error=error)

    return run


def refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry replaced by the floored mean of the parts nearest to it; the driver gets one row for each component of an entry."""
    part = rows.select("x").mapInPandas(_gather(books), "part int, entry int, n long, sums array<long>")
    flat = part.select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
    total = flat.groupBy("part", "entry", "at").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).collect()
    out = books.copy()
    for r in total:
        out[r["part"], r["entry"], r["at"]] = r["sum"] // r["n"]
    return out


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, vec: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part.

    The first codebooks are the parts of the ``entries`` least vec_ids (fewer vectors: fewer entries;
    rows of one vec_id in the order of their components, those without vec_id last). Rows whose vector is null, empty, or holds null or
    non-finite components are left out, and so are those of another length than most
    vectors; zeros fill the last part where the length is no multiple of 16. Repeated rows are
    kept. Components so large that 64 bits could not hold a distance count as the bound. A
    ``label_error`` beyond 64 bits is null. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, label string, code string, error long"
    # Any 2,048 dimensions at the bound keep a distance below 2**62.
    rows, dims = integer_vectors(vectors.withColumn("label", F.col("label").cast("string")), SCALE, 0, isqrt(2**62 // 2048) // 2, ("vec_id", "label"), vec)
    if not dims:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = -(-dims // PARTS)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).toPandas()
    books = _parts(first, width)
    for _ in range(rounds):
        books = refined(rows, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = written(rows.mapInPandas(_encode(books, ("vec_id", "label")), schema))
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")))
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
