"""Corpus-wide values of a document's elements, looked up through a dictionary for each block of documents.

Documents are dealt out in blocks by a hash of their id. What meets a corpus-wide table is
one row for each block and distinct element, not one for each occurrence, and a
document travels once, as an array of 64-bit names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from echofind.operators.joins import join_lookup

#: Occurrences of a block, on average. A worker holds one block and its dictionary.
BLOCK_NAMES = 4_000_000

#: Takes the documents of a block, the edges of their occurrences (document i has those from
#: ``edge[i]`` to ``edge[i + 1]``), each occurrence's name and its row of the dictionary
#: (-1: the element is not in it), and the dictionary.
Kernel = Callable[[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, pd.DataFrame], pd.DataFrame]


def flat(arrays: pd.Series) -> np.ndarray:
    """The values of a column of bigint arrays, one after the other; null arrays are empty."""
    parts = [np.asarray(a, np.int64) for a in arrays if a is not None]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def sums(values: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The sum of each document's occurrences."""
    filled = edge[1:] > edge[:-1]
    result = np.zeros(len(edge) - 1, values.dtype)
    if filled.any():
        result[filled] = np.add.reduceat(values, edge[:-1][filled])
    return result


def in_blocks(
    docs: DataFrame, lookup: DataFrame, kernel: Kernel, schema: StructType, id_col: str = "doc_id", block_names: int = BLOCK_NAMES
) -> DataFrame:
    """What ``kernel`` returns for each block of ``docs``, with the rows of ``lookup`` that the block needs.

    ``docs`` has ``names array<bigint>`` besides its id and is read three times, so it should be a stored
    table. ``lookup`` has one row for each ``name``. Starts a job that counts the names. Elements without a
    row in ``lookup`` are left to the kernel, and documents of no names get to it like any other.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.greatest(F.size("names"), F.lit(0)))).first()[0] or 0
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = max(slots, -(-total // block_names))
    dealt = docs.withColumn("_block", F.pmod(F.xxhash64(id_col), F.lit(blocks)))
    needed = dealt.select(F.col("_block").alias("_of"), F.explode("names").alias("name")).distinct()
    dictionary = join_lookup(needed, lookup, ["name"])

    def work(rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        entries = entries.sort_values("name").reset_index(drop=True)
        known = entries["name"].to_numpy(np.int64)
        edge = np.concatenate([[0], np.cumsum([0 if n is None else len(n) for n in rows["names"]])]).astype(np.int64)
        names = flat(rows["names"])
        at = np.minimum(np.searchsorted(known, names), max(0, len(known) - 1))
        at = np.where(known[at] == names, at, -1) if len(known) else np.full(len(names), -1)
        return kernel(rows.drop(columns=["names", "_block"]), edge, names, at, entries)

    # Blocks are even already, and a few bytes of names may be much work: they are not left to be merged by size.
    left, right = dealt.repartition(blocks, "_block"), dictionary.repartition(blocks, "_of")
    return left.groupBy("_block").cogroup(right.groupBy("_of")).applyInPandas(work, schema)
