"""Names of MinHash bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def band_names(signature: Column | str, num_bands: int, rows_per_band: int) -> list[Column]:
    """The 64-bit names of the bands of a MinHash signature; one shorter than the bands is an error."""
    column = F.col(signature) if isinstance(signature, str) else signature
    needed = num_bands * rows_per_band
    checked = F.when(
        F.size(column) < needed, F.raise_error(f"num_bands * rows_per_band = {needed} exceeds the signature length").cast("array<bigint>")
    ).otherwise(column)
    return [F.xxhash64(F.lit("band"), F.lit(k), F.slice(checked, 1 + k * rows_per_band, rows_per_band)) for k in range(num_bands)]
