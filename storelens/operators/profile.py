"""Profiling of a table: missing values, statistics of a column, counts of values."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.stats import null_percent, pearson
from storelens.operators.quantiles import approximate_quantiles, exact_quantiles, weighted_quantiles
from storelens.operators.radix import quantile_type


def null_percents(df: DataFrame) -> DataFrame:
    """One row with the percentage of nulls of every column, from a single pass."""
    return df.agg(*[null_percent(F.col(f"`{name}`")).alias(name) for name in df.columns])


def null_percents_long(df: DataFrame) -> DataFrame:
    """The same as rows of ``column`` and ``null_percent``."""
    return null_percents(df).unpivot([], [F.col(f"`{name}`") for name in df.columns], "column", "null_percent")


def column_statistics(df: DataFrame, column: str, *, approximate: bool = False) -> DataFrame:
    """One row: mean, std, min, max and median of the non-null values.

    The median is measured first (see ``quantiles``); of whole numbers and decimals it is exact at any size.
    """
    (median,) = _quantiles(df, column, [0.5], approximate)
    value = F.col(column)
    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        median.alias("median"),
    )


def weighted_statistics(df: DataFrame, column: str, weight: str) -> DataFrame:
    """``column_statistics`` of values that come with their numbers of occurrences."""
    present = df.where(F.col(column).isNotNull())
    (median,) = weighted_quantiles(present, column, weight, [0.5])
    value, times = F.col(column).cast("double"), F.col(weight)
    # Distances to the mean are squared, which is known first.
    mean = present.agg(F.sum(times * value) / F.sum(times)).scalar()
    away = value - mean
    return present.agg(
        F.try_divide(F.sum(times * value), F.sum(times)).alias("mean"),
        F.sqrt(F.sum(times * away * away) / F.nullif(F.sum(times) - 1, F.lit(0))).alias("std"),
        F.min(F.col(column)).alias("min"),
        F.max(F.col(column)).alias("max"),
        F.lit(median).cast(quantile_type(df.schema[column].dataType, False)).alias("median"),
    )


def describe_column(df: DataFrame, column: str, *, approximate: bool = False) -> DataFrame:
    """One row: count, mean, std, min, quartiles and max of the non-null values."""
    quartiles = _quantiles(df, column, [0.25, 0.5, 0.75], approximate)
    value = F.col(column)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        *[quartile.alias(name) for name, quartile in zip(("q25", "q50", "q75"), quartiles, strict=True)],
        F.max(value).alias("max"),
    )


def _quantiles(df: DataFrame, column: str, probabilities: list[float], approximate: bool) -> list[Column]:
    """The quantiles as literals: decimals for whole numbers and decimals, dates for dates, otherwise doubles."""
    if approximate:
        return [F.lit(found).cast("double") for found in approximate_quantiles(df, column, probabilities)]
    kind = quantile_type(df.schema[column].dataType, False)
    return [F.lit(found).cast(kind) for found in exact_quantiles(df, column, probabilities)]


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as rows, from a single pass.

    Every pair uses the rows where both values are present; each unordered pair
    is computed once and reported in both directions.
    """
    pairs = [(a, a) for a in columns] + list(combinations(columns, 2))
    names = {pair: f"r{i}" for i, pair in enumerate(pairs)}
    wide = df.agg(*[pearson(F.col(a), F.col(b)).alias(name) for (a, b), name in names.items()])
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(names.get((a, b)) or names[(b, a)]).alias("corr"))
        for a in columns
        for b in columns
    ]
    return wide.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), column)


def value_counts_map(df: DataFrame, column: str) -> DataFrame:
    """The counts as one map in one row, as a single JSON object holds them.

    The row grows with the number of values; ``value_counts`` has them as rows.
    """
    return counts_map(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")), column)


def counts_map(counts: DataFrame, column: str) -> DataFrame:
    """Rows of value and ``n`` as one map in one row, most frequent first."""
    # Equal to the order of value_counts, since arrays of structs sort by field.
    entries = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), column, "n")))
    pairs = F.transform(entries, lambda entry: F.struct(entry[column], entry["n"]))
    return counts.agg(F.map_from_entries(pairs).alias(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()
