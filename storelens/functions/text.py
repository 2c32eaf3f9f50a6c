"""Tokenising of titles and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that Python's str.split() treats as whitespace.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def tokens(text: Column) -> Column:
    """Lower-case words between runs of whitespace; null or blank text gives ``[]``."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), WHITESPACE)
    return F.array_remove(words, "")
