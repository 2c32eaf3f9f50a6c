"""Quantile sketches that can be stored and merged, and approximate quantiles whose rank errors are counted.

A sketch is a binary value of a few kilobytes.  Sketches of parts (days, partners, kinds) are stored as rows and
merged later into those of any larger part, without the rows.  A sketch's error bound holds with high probability only;
``audited_quantiles`` therefore counts, in one aggregate over the rows, how many values lie below and at each answer, and
asks again more exactly where the rank is off by more than allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.quantiles import exact_quantiles

#: Size parameters of the sketch: more is more exact.
SKETCH_SIZES = (200, 800, 3200)


def quantile_sketches(df: DataFrame, column: str, *groups: str, size: int = SKETCH_SIZES[0]) -> DataFrame:
    """One row per group: its key, the sketch of the column's non-null numbers, and their number ``n``."""
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull() & ~F.isnan(value))
    return present.groupBy(*groups).agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged_sketches(sketches: DataFrame, *groups: str) -> DataFrame:
    """Sketches of larger groups from those of their parts."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """The rows with an array ``quantiles``."""
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return sketches.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", asked)).drop("sketch")


def rank_errors(df: DataFrame, column: str, probabilities: Sequence[float], answers: Sequence[float]) -> DataFrame:
    """For every probability its answer, the numbers of values ``below`` and ``at`` it, ``n``, and how far its rank is off as a share of ``n``."""
    value = F.col(column).cast("double")
    counts = df.where(value.isNotNull() & ~F.isnan(value)).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(value < F.lit(a)).alias(f"below_{k}") for k, a in enumerate(answers)],
        *[F.count_if(value == F.lit(a)).alias(f"at_{k}") for k, a in enumerate(answers)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(float(p)).alias("probability"), F.lit(a).cast("double").alias("value"), F.col(f"below_{k}").alias("below"), F.col(f"at_{k}").alias("at"))
            for k, (p, a) in enumerate(zip(probabilities, answers, strict=True))
        ]
    )
    wanted = F.col("probability") * F.col("n")
    # The answer covers the ranks from below to below + at.
    off = F.greatest(F.col("below") - wanted, wanted - (F.col("below") + F.col("at")), F.lit(0.0))
    return counts.select("n", F.inline(rows)).withColumn("rank_error", F.try_divide(off, F.col("n")))


def audited_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01, sizes: Sequence[int] = SKETCH_SIZES) -> DataFrame:
    """Quantiles whose rank is off by at most ``relative_error``, by count, as rows of ``rank_errors``.

    Each size of sketch costs two aggregates; if even the largest misses the bound, the exact quantiles are taken.
    An empty column gives no rows.
    """
    for size in sizes:
        row = sketch_quantiles(quantile_sketches(df, column, size=size).where("n > 0"), probabilities).first()
        if row is None:
            return rank_errors(df, column, probabilities, [0.0] * len(probabilities)).where("n > 0")
        errors = rank_errors(df, column, probabilities, row["quantiles"])
        told = errors.agg(F.max("rank_error")).first()[0]
        if told is not None and told <= relative_error:
            return errors
    return rank_errors(df, column, probabilities, exact_quantiles(df, column, probabilities, discrete=True))
