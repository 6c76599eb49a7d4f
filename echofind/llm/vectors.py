"""Vectors of integers from tables of embeddings, for the operators on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import written


def integer_vectors(vectors: DataFrame, scale: int, offset: int, bound: int, keep: tuple[str, ...] = ("vec_id",), vec: str = "embedding") -> tuple[DataFrame, int]:
    """(``keep``, x) with x = floor(scale * component) + offset, written, and the number of dimensions.

    Rows whose vector is null or holds null or non-finite components are left out, and so
    are vectors that are empty or not of the length that most vectors have (the larger on ties).
    Scaled components beyond ``bound`` in size count as that bound, so that sums stay exact.
    """
    v = vectors.select(*keep, F.col(vec).cast("array<double>").alias("v")).filter("size(v) > 0")
    v = v.filter(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    limit = float(bound)
    x = F.transform("v", lambda c: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * F.lit(float(scale))))) + F.lit(offset))
    fixed = written(v.select(*keep, x.cast("array<long>").alias("x")))
    most = fixed.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return fixed, 0
    return fixed.filter(F.size("x") == most["d"]), most["d"]
