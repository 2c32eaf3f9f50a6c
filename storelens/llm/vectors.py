"""Vectors that can be compared: complete, finite and not zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is neither null, empty nor zero and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~bad & nonzero, F.lit(False))


def as_doubles(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Columns id (long) and vec (array of double) of all rows."""
    return df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
