"""Where intermediate tables live and how scans are spread."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_dir(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint directory.

    The cluster names that directory in ``spark.checkpoint.dir``. Where it is unset a
    temporary folder is chosen on ``local[*]`` only: anywhere else executors
    would not see each other's files, so that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = spark.conf.get("spark.echofind.localDir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="echofind-")
        spark.conf.set("spark.echofind.localDir", base)
    return f"{base.rstrip('/')}/echofind-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan by ``key`` when it has fewer tasks than the session has slots.

    A corpus of one small file would otherwise be cleaned and shingled by one
    task. A large scan is returned unchanged, so nothing is shuffled for it.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(4 * slots, key)


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and return its scan.

    For tables that the following plan reads several times. The scan is a
    leaf, so the plan stays small and no lost executor reruns what is behind it.
    """
    path = f"{shared_dir(df.sparkSession)}/table.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
