"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is the greatest
within ``NEAR`` bytes, so a boundary depends on 48 bytes before and 16 after it only and
an insertion moves no boundary further on. In a text that repeats a few bytes the
greatest ones tie and each of them is a boundary, so its chunks are whole periods. Chunks are compared by digest: the first place of a digest, by
document and offset, keeps its bytes, every later one is a duplicate. Duplicates are removed in runs: neighbouring
chunks whose first places are neighbours too, of ``LEAST_RUN`` bytes together or the whole text.
Short phrases that texts share by chance stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echofind.llm.common import byte_codes, slices, written

#: Chunks have LEAST to MOST bytes (the last of a text may be shorter); those of prose have about 36.
LEAST, MOST = 16, 512
#: Bytes on each side over which the hash at a boundary is the greatest; a power of two.
NEAR = 16
#: Bytes of a run of duplicate chunks that is removed. A repeated passage loses up to a chunk at each end before its run counts.
LEAST_RUN = 100
SLICE_BYTES = 4 << 20
CHUNKS = "doc_id long, start int, size int, total int, high long, low long"


def gear(data: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash at each byte: (hash << 1) + code of the byte, so it reaches back 32 bytes."""
    h = (byte_codes() >> np.uint64(32)).astype(np.uint32)[data]
    for k in range(5):
        step = 1 << k
        if step < len(h):
            longer = h.copy()
            longer[step:] += h[:-step] << np.uint32(step)
            h = longer
    return h


def marks(h: np.ndarray) -> np.ndarray:
    """The ends that the hash proposes: after each byte whose hash no other within NEAR bytes exceeds."""
    top, step = h.copy(), 1  # the greatest of NEAR hashes from here on
    while step < NEAR:
        top[:-step] = np.maximum(top[:-step], top[step:])
        step *= 2
    proposed = np.ones(len(h), bool)
    proposed[:-1] = h[:-1] >= top[1:]
    before = np.maximum.accumulate(h[:NEAR])
    proposed[1 : len(before)] &= h[1 : len(before)] >= before[:-1]
    proposed[NEAR:] &= h[NEAR:] >= top[:-NEAR]
    return np.flatnonzero(proposed) + 1


def cuts(size: int, marks: np.ndarray) -> list[int]:
    """Ends of the chunks of a text of ``size`` bytes; ``marks`` are the ends that the hash proposes."""
    out, at = [], 0
    for mark in marks.tolist():
        while mark - at > MOST:
            at += MOST
            out.append(at)
        if mark - at >= LEAST:
            out.append(mark)
            at = mark
    while size - at > MOST:
        at += MOST
        out.append(at)
    if size > at:
        out.append(size)
    return out


def text_chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """The chunk ends of each text. A text's bytes before its own start never reach its hash."""
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        yield cuts(len(data), marks(gear(data)))


def chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = xxhash.xxh3_128_intdigest
    for batch in batches:
        encoded = [(t or "").encode() for t in batch["text"]]
        for a, b in slices(encoded, SLICE_BYTES):
            ids, starts, sizes, totals, digests = [], [], [], [], []
            for doc_id, text, ends in zip(batch["doc_id"].iloc[a:b], encoded[a:b], text_chunks(encoded[a:b]), strict=True):
                begins = [0, *ends[:-1]] if ends else []
                ids += [doc_id] * len(ends)
                starts += begins
                totals += [len(text)] * len(ends)
                sizes += [e - s for s, e in zip(begins, ends, strict=True)]
                digests += [digest(text[s:e]) for s, e in zip(begins, ends, strict=True)]
            names = np.frombuffer(b"".join(d.to_bytes(16, "little") for d in digests), np.int64).reshape(-1, 2)
            for i in range(0, len(ids), 200_000):
                j = slice(i, i + 200_000)
                yield pd.DataFrame({"doc_id": ids[j], "start": starts[j], "size": sizes[j], "total": totals[j], "high": names[j, 0], "low": names[j, 1]})


def duplicate_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, start, size, total, first_doc, first_start of every chunk whose digest has an earlier place; ``total`` is its text's size."""
    chunks = docs.select("doc_id", "text").filter("doc_id is not null and text <> ''").mapInPandas(chunked, CHUNKS)
    # Rows of one digest are folded in each task first; the few digests that repeat are joined back, and that join may be split.
    firsts = chunks.groupBy("high", "low").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("high", "low", "first")
    repeated = written(firsts)
    again = chunks.join(repeated, ["high", "low"]).filter("doc_id <> first.doc_id or start <> first.start")
    return again.select("doc_id", "start", "size", "total", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start"))


def duplicate_runs(chunks: DataFrame) -> DataFrame:
    """doc_id, start, size, total, first_doc, n of every run of duplicate chunks that follow each other here and at their first place, or are one chunk over and over."""
    # A document's chunks are bounded by its text; equal chunks of repeated rows count once.
    place = Window.partitionBy("doc_id", "start", "size").orderBy("first_doc", "first_start")
    order = Window.partitionBy("doc_id").orderBy("start", "size")
    once = chunks.repartition("doc_id").withColumn("again", F.row_number().over(place)).filter("again = 1")
    start, size, doc, first = (F.lag(c).over(order) for c in ("start", "size", "first_doc", "first_start"))
    # A chunk that is repeated on the spot has the first place of the one before.
    follows = (F.col("start") == start + size) & (F.col("first_doc") == doc) & ((F.col("first_start") == first + size) | (F.col("first_start") == first))
    marked = once.withColumn("opens", F.when(follows, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("opens").over(order)).groupBy("doc_id", "run")
    return runs.agg(*(F.min(c).alias(c) for c in ("start", "total", "first_doc")), F.sum("size").cast("int").alias("size"), F.count("*").alias("n")).drop("run")


def deduplicate(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """doc_id, n_bytes, n_duplicates, n_removed, n_single and the removed spans of every row of ``docs``.

    ``removed`` is an array of (start, end, first_doc) by start, in bytes of the UTF-8 text: runs of duplicate chunks of
    ``least_run`` bytes or of the whole text. ``n_duplicates`` counts their chunks, ``n_single`` the duplicate chunks
    that stay because their run is shorter. A null or empty text has no chunks; texts of any length are read whole. Chunks that repeat inside a document count too.
    Of rows with one doc_id each takes the spans of all; rows without doc_id
    take no part; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    long = (F.col("size") >= least_run) | (F.col("size") == F.col("total"))
    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"), "first_doc")
    spans = duplicate_runs(duplicate_chunks(docs)).groupBy("doc_id").agg(
        F.sum(F.when(long, F.col("n"))).alias("n_duplicates"),
        F.sum(F.when(long, F.col("size").cast("long"))).alias("n_removed"),
        F.sum(F.when(~long, F.col("n"))).alias("n_single"),
        F.array_sort(F.collect_list(F.when(long, span))).alias("removed"),
    )
    sizes = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    none = F.array().cast("array<struct<start:int,end:int,first_doc:long>>")
    counts = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_duplicates", "n_removed", "n_single"))
    return sizes.join(spans, "doc_id", "left").select("doc_id", "n_bytes", *counts, F.coalesce("removed", none).alias("removed"))
