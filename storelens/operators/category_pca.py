"""Principal components of one-hot categories, from the counts of the categories alone.

With counts ``c`` of N rows the covariance of the one-hot columns is, up to the factor 1 / (N - 1), the
diagonal of ``c`` less the rank-one matrix ``c c' / N``.  Its eigenvalues are the roots of the secular equation
``sum c_i^2 / (N (c_i - x)) = 1``, one between two neighbouring different counts and one at zero, and, where m
categories share a count, that count m - 1 times.  So no matrix is built.  All that the driver
needs is how many categories have each count: N rows have at most sqrt(2 N) different counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.joins import lookup_join

BISECTIONS = 200


@dataclass(frozen=True)
class Component:
    """A root ``below`` under ``count``, with the norm of its vector; or the contrast ``tie`` among categories of that count."""

    count: int
    below: float
    norm: float
    tie: int = 0

    def eigenvalue(self, rows: int) -> float:
        return (self.count - self.below) / (rows - 1) if rows > 1 else 0.0

    def mean(self) -> float:
        """Mean of the rows' projections; a contrast has none, and by the secular equation any other has the inverse norm."""
        return 0.0 if self.tie else 1 / self.norm

    def loading(self, n: Column, place: Column) -> Column:
        """The entry of a category with so many rows and that place among those with the same number."""
        if not self.tie:
            # The difference of whole numbers first, so that nothing cancels next to a root.
            return n / ((n - F.lit(self.count)) + F.lit(self.below)) / F.lit(self.norm)
        root = math.sqrt(self.tie * (self.tie + 1))
        inside = F.when(place < self.tie, 1 / root).when(place == self.tie, -self.tie / root).otherwise(0.0)
        return F.when(n == self.count, inside).otherwise(0.0)


def solve_components(levels: list[tuple[int, int]], k: int) -> list[Component]:
    """The first ``k`` components, by falling eigenvalue, of (count, number of categories with it) from large to small."""
    counts, many = (np.array(x, dtype=float) for x in zip(*levels, strict=True))
    total = float((counts * many).sum())
    found: list[Component] = []
    for j, (count, number) in enumerate(levels):
        found += [Component(count, 0.0, 1.0, tie) for tie in range(1, min(number - 1, k - len(found)) + 1)]
        if len(found) >= k:
            break
        away = counts - count
        if j + 1 < len(levels):
            low, high = 0.0, float(count - levels[j + 1][0])
            for _ in range(BISECTIONS):
                middle = (low + high) / 2
                if (many * counts**2 / (total * (away + middle))).sum() > 1:
                    low = middle
                else:
                    high = middle
            below = (low + high) / 2
        else:
            below = float(count)  # the root at zero
        found.append(Component(count, below, math.sqrt((many * (counts / (away + below)) ** 2).sum())))
        if len(found) >= k:
            break
    return found


@dataclass(frozen=True)
class CategoryComponents:
    """Fitted components: ``counts`` has the categories with their rows ``n``."""

    column: str
    counts: DataFrame
    rows: int
    components: list[Component]

    def means(self) -> list[float]:
        return [component.mean() for component in self.components]

    def eigenvalues(self) -> list[float]:
        return [component.eigenvalue(self.rows) for component in self.components]

    def loadings(self) -> DataFrame:
        """Category, its rows ``n`` and the array ``loadings`` with an entry per component."""
        place = F.lit(None).cast("int")
        counts = self.counts
        ties: dict[int, int] = {}
        for component in self.components:
            if component.tie:
                ties[component.count] = max(component.tie, ties.get(component.count, 0))
        if ties:
            # Only the first few categories of a shared count take part in its contrasts.
            firsts = [
                [(row[0], at) for at, row in enumerate(counts.where(F.col("n") == count).orderBy(self.column).limit(most + 1).select(self.column).collect())]
                for count, most in ties.items()
            ]
            schema = f"`{self.column}` string, place int"
            placed = counts.sparkSession.createDataFrame([pair for some in firsts for pair in some], schema)
            counts = counts.join(F.broadcast(placed), self.column, "left")
            place = F.coalesce(F.col("place"), F.lit(2**31 - 1))
        n = F.col("n").cast("double")
        return counts.select(self.column, "n", F.array(*[c.loading(n, place) for c in self.components]).alias("loadings"))

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        """The rows of known categories with their projection."""
        flat = self.loadings().select(self.column, *[F.col("loadings")[k].alias(f"_load_{k}") for k in range(len(self.components))])
        joined = lookup_join(df, flat, self.column)
        return joined.withColumn(output, F.array(*[F.col(f"_load_{k}") for k in range(len(self.components))])).drop(*flat.columns[1:])


def category_counts(df: DataFrame, column: str, invalid: str = "error") -> DataFrame:
    """Categories and their rows; ``invalid`` says whether nulls raise an ``error``, are left out (``skip``) or are a category of their own (``keep``)."""
    if invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown way to treat nulls: {invalid}")
    value = F.col(f"`{column}`").cast("string").alias(column)
    if invalid == "skip":
        df = df.where(F.col(f"`{column}`").isNotNull())
    return df.select(value).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def fit_components(df: DataFrame, column: str, k: int, invalid: str = "error") -> CategoryComponents:
    """Components of the one-hot columns of a category (runs one aggregate over the rows)."""
    counts = category_counts(df, column, invalid)
    levels = counts.groupBy("n").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col(column).isNull()).alias("nulls")).orderBy(F.desc("n")).collect()
    if invalid == "error" and any(row["nulls"] for row in levels):
        raise ValueError(f"{column} holds null values")
    if not levels:
        return CategoryComponents(column, counts, 0, [])
    rows = sum(row["n"] * row["m"] for row in levels)
    return CategoryComponents(column, counts, rows, solve_components([(row["n"], row["m"]) for row in levels], k))


def category_means(df: DataFrame, column: str, *, k: int, invalid: str = "error") -> DataFrame:
    """One row: number of rows, mean one-hot vector in the order of ``index_categories``, and mean of the first ``k`` components."""
    fitted = fit_components(df, column, k, invalid)
    # Most frequent first, then by name, a kept null last.
    entries = F.sort_array(F.collect_list(F.struct(F.col(column).isNull().alias("null"), (-F.col("n")).alias("order"), F.col(column))))
    total = F.sum("n")
    share = fitted.counts.agg(total.alias("count_total"), entries.alias("entries"))
    return share.select(
        F.coalesce("count_total", F.lit(0).cast("long")).alias("count_total"),
        F.transform("entries", lambda entry: -entry["order"] / F.col("count_total")).alias(f"meanVector_{column}OneHot"),
        F.array(*[F.lit(mean) for mean in fitted.means()]).cast("array<double>").alias(f"meanVector_{column}PCA"),
    )
