"""Run metrics: stage runtimes, parameters and results of one run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SECTIONS = ("runtime", "param", "result")


@dataclass
class RunMetrics:
    """Three small dictionaries that become one table ``(section, name, value)``."""

    runtime: dict[str, float] = field(default_factory=dict)
    params: dict[str, Any] = field(default_factory=dict)
    results: dict[str, Any] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        """Time a stage; it should end in the action that runs its job."""
        start = time.perf_counter()
        yield
        self.runtime[name] = time.perf_counter() - start

    def rows(self) -> list[tuple[str, str, str]]:
        parts = zip(SECTIONS, (self.runtime, self.params, self.results))
        return [(section, name, str(value)) for section, values in parts for name, value in values.items()]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "section string, name string, value string")

    def write(self, spark: SparkSession, path: str) -> None:
        """One CSV file; the table has a row per stage, parameter and result."""
        self.table(spark).coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("section string, name string, value string").option("header", True).csv(path)
