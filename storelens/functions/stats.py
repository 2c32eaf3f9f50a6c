"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_count(value: Column) -> Column:
    return F.count_if(value.isNull())


def null_percent(value: Column) -> Column:
    """Share of nulls in percent; null for an empty table."""
    return F.try_divide(null_count(value), F.count(F.lit(1))) * F.lit(100.0)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both sides are present.

    A constant side gives null: the built-in ``corr`` divides by zero there and
    raises under ANSI mode.
    """
    complete = x.isNotNull() & y.isNotNull()
    spread = F.stddev_samp(F.when(complete, x)) * F.stddev_samp(F.when(complete, y))
    return F.try_divide(F.covar_samp(x, y), spread)


def root_mean_square(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))
