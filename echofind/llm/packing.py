"""Packing of sequences into padded batches with optimal length buckets.

The histogram of all lengths up to the token budget is the only thing gathered. Dynamic
programming over it chooses the bucket boundaries that minimise padding; inside a bucket, rows are
numbered across all tasks and every ``budget // boundary`` of them form a batch. A row
longer than the budget is a batch by itself and needs no padding, so it has no part in the choice.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echofind.llm.common import private, written


def word_length(text: Column) -> Column:
    """Whitespace-separated words, counted in one pass; null and empty texts have 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0))


def boundaries(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least padding.

    ``totals`` are the summed lengths of each cell. Cost of cells i..j in one bucket is
    counts(i..j) * lengths[j] - totals(i..j). The best last cut moves right with j, so each
    layer is solved by divide and conquer; equal costs take the smaller cut.
    """
    n = len(lengths)
    if n == 0:
        return []
    seen, summed = np.concatenate([[0], np.cumsum(counts)]).astype(object), np.concatenate([[0], np.cumsum(totals)]).astype(object)
    seen, summed = seen.astype(np.float64), summed.astype(np.float64)
    size = lengths.astype(np.float64)
    best = seen[1:] * size - summed[1:]
    cuts = [np.zeros(n, np.int64)]
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.zeros(n, np.int64)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            low, high, left, right = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(max(1, left), min(j, right) + 1)  # the last bucket holds cells i..j
            if len(i):
                cost = best[i - 1] + (seen[j + 1] - seen[i]) * size[j] - (summed[j + 1] - summed[i])
                k = int(np.argmin(cost))
                if cost[k] < now[j]:
                    now[j], cut[j] = cost[k], i[k]
            at = int(cut[j])
            todo += [(low, j - 1, left, max(at, 1)), (j + 1, high, max(at, left), right)]
        cuts.append(cut)
        best = now
    out, j = [], n - 1
    for cut in reversed(cuts):
        out.append(int(lengths[j]))
        if cut[j] == 0:
            break
        j = int(cut[j]) - 1
    return out[::-1]


def plan(docs: DataFrame, length: Column, buckets: int, budget: int) -> list[int]:
    """Bucket boundaries for all rows that fit the budget. The driver gets one row for each length: ``budget`` + 1 at most."""
    sized = docs.select(F.coalesce(length, F.lit(0)).cast("long").alias("n")).filter(F.col("n") <= budget)
    rows = sized.groupBy("n").agg(F.count("*").alias("c")).orderBy("n").collect()
    table = np.array([(r["n"], r["c"]) for r in rows], np.int64).reshape(-1, 2)
    return boundaries(table[:, 0], table[:, 1], table[:, 0] * table[:, 1], buckets)


def pack(docs: DataFrame, length: Column, budget: int = 16_384, buckets: int = 16, shard_rows: int = 50_000) -> DataFrame:
    """Each row of ``docs`` with ``length``, ``bucket``, ``boundary``, ``batch``, ``slot`` and ``padding``.

    A batch is named by (bucket, batch) and holds ``budget // boundary`` rows, the last
    of a bucket fewer. No row is cut or left out: those longer than the budget are in the last bucket, each a batch by
    itself with its own length as boundary. An empty or null text has length 0. ``doc_id`` orders the rows, ties and
    repeated rows follow in any order. An empty table stays empty. Columns named like the
    new ones are replaced; any other name is free.
    """
    new = ("length", "bucket", "boundary", "batch", "slot", "padding")
    # Lengths are measured once; every later pass reads what is written here.
    sized = written(docs.withColumn("length", F.coalesce(length, F.lit(0)).cast("long")).select(*(c for c in docs.columns if c not in new), "length"))
    tops = plan(sized, F.col("length"), buckets, budget)
    top = F.array(*(F.lit(t).cast("long") for t in tops)) if tops else F.array().cast("array<long>")
    bucket = F.size(F.filter(top, lambda t: t < F.col("length"))).cast("int")
    placed = sized.withColumn("bucket", bucket).withColumn("boundary", F.coalesce(F.get(top, F.col("bucket")), F.col("length")))
    # A bucket may hold most rows, so it is numbered in shards; the shards' counts give each its offset.
    shard, at, count, offset = private(sized, "shard", "at", "count", "offset")
    shards = max(1, -(-sized.count() // shard_rows))
    placed = placed.withColumn(shard, F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    sizes = placed.groupBy("bucket", shard).agg(F.count("*").alias(count))
    before = Window.partitionBy("bucket").orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", shard, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(offset))
    here = Window.partitionBy("bucket", shard).orderBy("doc_id", "length")
    numbered = placed.withColumn(at, F.row_number().over(here)).join(offsets, ["bucket", shard])
    place = F.col(offset) + F.col(at) - 1
    capacity = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("boundary")))).cast("long")
    return numbered.withColumns(
        {"batch": F.floor(place / capacity).cast("long"), "slot": (place % capacity).cast("long"), "padding": F.col("boundary") - F.col("length")}
    ).select(*sized.columns, *new[1:])
