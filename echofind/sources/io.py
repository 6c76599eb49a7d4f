"""Corpus, signature and pair files (parquet and CSV)."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofind.functions.hashing import signature_to_binary
from echofind.sources.store import stored

PAIR_SCHEMA = T.StructType([T.StructField("id1", T.LongType()), T.StructField("id2", T.LongType())])
FORMATS = ("parquet", "csv")
# Quotes are doubled and outer blanks kept, so that any text comes back as written.
CSV_WRITE = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _path_format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported file type {suffix!r} of {path}; use .parquet or .csv")
    return suffix


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _require_path(spark: SparkSession, path: str) -> bool:
    """True for a directory; a missing path is an error."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(f"Path does not exist: {path}")
    return fs.getFileStatus(target).isDirectory()


def _csv_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The CSV files below a directory, by their header line.

    The first line of a file is the first row of its first block, and blocks
    are read in order within a task. The driver gets one path for each file, and
    nothing else.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
    first = (
        lines.where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("header"))
    )
    return [r["files"] for r in first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()]


def _parquet_folders(spark: SparkSession, path: str) -> list[list[str]]:
    """The parquet files below a directory, by folder: each folder is read with a schema of its own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    named = files.load(path).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "path")
    return [r["files"] for r in named.groupBy("folder").agg(F.array_sort(F.collect_list("path")).alias("files")).collect()]


def _frames(spark: SparkSession, path: str, kind: str, directory: bool, ignore_corrupt: bool, multi_line: bool) -> list[DataFrame]:
    """A scan for each set of files that agree on their columns."""
    reader = spark.read.option("ignoreCorruptFiles", ignore_corrupt)
    if kind == "parquet":
        frames = []
        for group in _parquet_folders(spark, path) if directory else [[path]]:
            try:
                frames.append(reader.option("mergeSchema", True).parquet(*group))
            except AnalysisException as error:  # a folder of nothing but corrupt files has no schema
                if not (ignore_corrupt and error.getCondition() == "UNABLE_TO_INFER_SCHEMA"):
                    raise
        return frames
    # A header that differs from the one read first fails; CSV has no null, so empty and missing fields are empty texts.
    reader = reader.options(**CSV_WRITE, multiLine=multi_line, enforceSchema=False)
    return [reader.csv(group).na.fill("") for group in (_csv_groups(spark, path) if directory else [[path]])]


def _has_files(spark: SparkSession, path: str, kind: str) -> bool:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}")
    return not files.load(path).select("path").isEmpty()


def read_corpus(
    spark: SparkSession,
    path: str,
    id_column: str | None = None,
    text_column: str = "text",
    ignore_corrupt_files: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """``(doc_id, text)`` from a parquet or CSV file, or every such file below a directory.

    Columns are taken by name. CSV files of a directory may differ in their
    columns; parquet files may differ from folder to folder. ``id_column`` names the
    document id; without it the rows are numbered and stored once, so that the
    ids hold in every later job. Missing paths, other file types and a missing
    text column are errors. Unreadable files fail the read unless
    ``ignore_corrupt_files`` is set. With ``multi_line=False`` no CSV field may hold a
    line break, and large CSV files are read by several tasks.
    """
    directory = _require_path(spark, path)
    kinds = [k for k in FORMATS if _has_files(spark, path, k)] if directory else [_path_format(path)]
    frames = [f for kind in kinds for f in _frames(spark, path, kind, directory, ignore_corrupt_files, multi_line)]
    if not frames:
        raise ValueError(f"No parquet or CSV data under {path}")
    for frame in frames:
        if text_column not in frame.columns:
            raise ValueError(f"Column {text_column!r} is missing in {path}")
        if id_column is not None and id_column not in frame.columns:
            raise ValueError(f"Column {id_column!r} is missing in {path}")
    wanted = [text_column] if id_column is None else [id_column, text_column]
    merged = frames[0].select(*wanted)
    for frame in frames[1:]:
        merged = merged.unionByName(frame.select(*wanted))
    doc_id: Column = F.monotonically_increasing_id() if id_column is None else F.col(id_column).cast("bigint")
    corpus = merged.select(doc_id.alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return stored(corpus) if id_column is None else corpus


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``(id1, id2)`` from header-less CSV; rows of any other shape fail the read."""
    _require_path(spark, path)
    if _path_format(path) != "csv":
        raise ValueError("Candidate pairs are read from CSV only")
    return spark.read.schema(PAIR_SCHEMA).option("mode", "FAILFAST").csv(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """``id1,id2`` lines without a header, each pair once."""
    pairs.select("id1", "id2").distinct().write.mode("overwrite").csv(path, header=False)


def _write(df: DataFrame, path: str) -> int:
    """Write by suffix and return the row count, taken while writing.

    The rows go to a folder beside ``path`` first and replace it only when there
    are any, so an empty result leaves an earlier output as it was.
    """
    spark = df.sparkSession
    kind = _path_format(path)
    counter = Observation()
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.{kind}"
    writer = df.observe(counter, F.count(F.lit(1)).alias("n")).write
    if kind == "csv":
        writer.options(**CSV_WRITE).csv(beside)
    else:
        writer.parquet(beside)
    rows = counter.get["n"]
    source, fs = _hadoop_path(spark, beside)
    if not rows:
        fs.delete(source, True)
        raise ValueError(f"No rows to save in {path}")
    target, _ = _hadoop_path(spark, path)
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{beside} could not be renamed to {path}")
    return rows


def write_preprocessed(df: DataFrame, path: str, text: str = "text", id_col: str | None = None) -> int:
    """The text column as parquet or CSV with a header; no rows is an error."""
    columns = [F.col(text).alias("text")] if id_col is None else [F.col(id_col), F.col(text).alias("text")]
    return _write(df.select(*columns), path)


def write_signatures(
    df: DataFrame,
    path: str,
    num_hashes: int | None = None,
    hash_bits: int | None = None,
    signature: str = "signature",
    id_col: str = "doc_id",
) -> int:
    """Signatures as parquet or CSV; no rows is an error.

    Parquet keeps every column as typed. CSV has the id and one column per hash,
    named ``0 .. num_hashes-1``, for MinHash arrays, or a ``text`` column with the
    binary string for bit signatures. An array of another length than
    ``num_hashes`` fails the write; a null array is a line of empty fields.
    """
    if _path_format(path) == "parquet":
        return _write(df, path)
    if isinstance(df.schema[signature].dataType, T.ArrayType):
        if num_hashes is None:
            raise ValueError("num_hashes is needed for the CSV layout of MinHash signatures")
        wrong = F.raise_error(F.format_string(f"a signature has %d values, num_hashes is {num_hashes}", F.size(signature)))
        values = F.when(F.size(signature) != num_hashes, wrong.cast(df.schema[signature].dataType)).otherwise(F.col(signature))
        checked = df.select(id_col, values.alias("values"))
        layout = checked.select(id_col, *[F.get(F.col("values"), i).alias(str(i)) for i in range(num_hashes)])
    else:
        if hash_bits is None:
            raise ValueError("hash_bits is needed for the CSV layout of bit signatures")
        layout = df.select(id_col, signature_to_binary(signature, hash_bits).alias("text"))
    return _write(layout, path)
