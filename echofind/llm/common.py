"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MASK64 = (1 << 64) - 1
# An odd multiplier, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only on ``local[*]`` where that is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark.conf.get("spark.echofind.llmDir", None)
        if not base:
            base = tempfile.mkdtemp(prefix="echofind-llm-")
            spark.conf.set("spark.echofind.llmDir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and return its scan: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def co_located(df: DataFrame, parts: int, key: str) -> DataFrame:
    """A checkpoint of ``df`` in ``parts`` partitions by the hash of ``key``; joins by that key leave it where it is.

    A plan under adaptive execution does not tell how its rows lie, so this one step goes without.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch(spark))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.repartition(parts, key).checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that begin like none of ``df``'s."""
    lead = "_"
    while any(c.lower().startswith(lead) for c in df.columns):
        lead += "_"
    return [lead + name for name in names]


def release() -> None:
    """Give freed memory back to the system: a worker goes from stage to stage and otherwise keeps the most that any of them took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, with ``release`` before and after it: a worker that then stays idle holds little."""

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        release()
        yield from work(batches)
        release()

    return run


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_codes(seed: int = 7) -> np.ndarray:
    """A random 64-bit code for each byte value, the same in every process."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


def slices(arrays, limit: int):
    """Cut a list of byte strings into runs of about ``limit`` bytes (one longer string is a run by itself)."""
    start = size = 0
    for i, value in enumerate(arrays):
        if i > start and size + len(value) > limit:
            yield start, i
            start, size = i, 0
        size += len(value)
    if start < len(arrays):
        yield start, len(arrays)
