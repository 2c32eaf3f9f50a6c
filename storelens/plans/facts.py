"""Counts of everything a report asks of a table, from one scan for its rows and one for its lists.

Rows are counted by key and number, with the nulls of every column beside them; the items of lists by list and item.
Equal ones are counted in every task before they are moved, so a very common key, category or value is
one row per task.  The counts are written once and all answers are taken from them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.layout import written


def counted_rows(rows: DataFrame, key: str, number: str, described: Sequence[str]) -> DataFrame:
    """Columns key, number, ``n`` rows that have them, and ``nulls_0`` ... for the nulls in the columns ``described``."""
    nulls = [F.count_if(F.col(f"`{name}`").isNull()).alias(f"nulls_{k}") for k, name in enumerate(described)]
    return rows.groupBy(F.col(f"`{key}`").alias("key"), F.col(f"`{number}`").alias("number")).agg(F.count(F.lit(1)).alias("n"), *nulls)


def counted_items(rows: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """Columns list, item and ``n``: the non-null items of the named array columns."""
    none = F.array().cast("array<struct<list:string,item:string>>")

    def entries(name: str, items: Column) -> Column:
        return F.coalesce(F.transform(items, lambda item: F.struct(F.lit(name).alias("list"), item.cast("string").alias("item"))), none)

    every = F.concat(*[entries(name, items) for name, items in lists.items()])
    return rows.select(F.inline(every)).where(F.col("item").isNotNull()).groupBy("list", "item").agg(F.count(F.lit(1)).alias("n"))


def written_rows(rows: DataFrame, key: str, number: str, described: Sequence[str]) -> DataFrame:
    """``counted_rows`` in the shared folder (runs one scan)."""
    return written(counted_rows(rows, key, number, described), "facts")


def written_items(rows: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """``counted_items`` in the shared folder (runs one scan)."""
    return written(counted_items(rows, lists), "facts")


def null_percents_of(facts: DataFrame, described: Sequence[str]) -> DataFrame:
    """One row with the percentage of nulls of every column; nulls for a table without rows."""
    return facts.agg(*[(F.try_divide(F.sum(f"nulls_{k}"), F.sum("n")) * F.lit(100.0)).alias(name) for k, name in enumerate(described)])


def numbers_of(facts: DataFrame, key: str, number: str) -> DataFrame:
    """Key, number and how many rows have both, the key null where the row's is."""
    return facts.select(F.col("key").alias(key), F.col("number").alias(number), "n")


def items_of(facts: DataFrame, name: str, item: str) -> DataFrame:
    """Items of a list and their number."""
    return facts.where(F.col("list") == name).select(F.col("item").alias(item), "n")
