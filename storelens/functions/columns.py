"""Null handling, casts and nested access as plain Spark expressions.

All of them stay inside generated code and none raises under ANSI mode: a
missing element, an unreadable number or a zero divisor gives null.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def label_if_blank(value: Column, label: str) -> Column:
    """The value, or ``label`` where it is null or the empty string."""
    return F.coalesce(blank_to_null(value), F.lit(label))


def to_float(value: Column) -> Column:
    """Single-precision number; text that is not a number becomes null."""
    return value.try_cast("float")


def fill_null(value: Column, substitute: float | None) -> Column:
    """Double-precision value with nulls replaced; a null substitute replaces nothing."""
    return F.coalesce(value.cast("double"), F.lit(substitute).cast("double"))


def first_key(mapping: Column) -> Column:
    """Key of the first stored entry of a map, null for a null or empty map."""
    return F.get(F.map_keys(mapping), F.lit(0))


def first_value(mapping: Column) -> Column:
    return F.get(F.map_values(mapping), F.lit(0))


def first_of_first(nested: Column) -> Column:
    """First element of the first inner list, null when absent or blank."""
    return blank_to_null(F.get(F.get(nested, F.lit(0)), F.lit(0)))


def has_items(items: Column) -> Column:
    """True only for a list with at least one element."""
    return F.coalesce(F.size(items) > 0, F.lit(False))


def concat_lists(lists: Iterable[Column]) -> Column:
    """All elements of several lists of text in order; null lists count as empty."""
    return F.concat(*[F.coalesce(items, F.array().cast("array<string>")) for items in lists])
