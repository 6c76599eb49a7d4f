"""A join shape that adaptive execution can split on hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to an aggregate with one row per key.

    An aggregate grouped by the join keys would be joined in the layout it
    already has, and Spark splits a skewed partition only where both inputs
    come straight from a shuffle. Joining on a struct of the keys gives the
    aggregate its own small shuffle, so that a key held by a third of all rows
    is spread over many tasks.
    """
    left_columns = [c for c in rows.columns if c not in keys]
    right_columns = [c for c in lookup.columns if c not in keys]
    left = rows.select(F.struct(*keys).alias("_on"), *left_columns)
    right = lookup.select(F.struct(*keys).alias("_on"), *right_columns)
    return left.join(right, "_on", how).select("_on.*", *left_columns, *right_columns)
