"""Exact quantiles of a column that may not fit in one task.

``percentile`` and ``median`` merge one entry per distinct value in a single
task.  Here an approximate sketch only proposes cut values around the wanted
rank; counting the rows below and at each cut is exact and tells which narrow
range holds the rank.  The range shrinks by orders of magnitude per round until
few enough values are left to be sorted in one task.  Each round is two
aggregates with a few numbers as their result.

That is for floating numbers; whole numbers, decimals and dates never pass through a double but are settled
digit by digit (see ``radix``).
"""

from __future__ import annotations

import math
import operator
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators.radix import has_radix_key, radix_quantiles

SORTED_IN_ONE_TASK = 500_000
SKETCH_ACCURACY = 10_000
CUTS_EACH = 200

_V = "_v"


@dataclass(frozen=True)
class _Range:
    """Values strictly between two bounds, and the 0-based ranks wanted among them."""

    low: float | None
    high: float | None
    size: int
    ranks: dict[int, int]  # rank within the range: rank among all values

    def holds(self) -> Column:
        above = F.lit(True) if self.low is None else F.col(_V) > self.low
        below = F.lit(True) if self.high is None else F.col(_V) < self.high
        return above & below


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    *,
    discrete: bool = False,
    sorted_in_one_task: int = SORTED_IN_ONE_TASK,
    accuracy: int = SKETCH_ACCURACY,
) -> list:
    """Quantiles of the non-null values (runs a few jobs).

    Between two values the result is interpolated, or with ``discrete`` it is the
    lower of them that covers the probability.  An empty column gives nulls.  Whole numbers and
    decimals give exact decimals, with ``discrete`` their own type.
    """
    if has_radix_key(df.schema[column].dataType):
        return radix_quantiles(df, column, probabilities, discrete=discrete)
    values = df.select(F.col(column).cast("double").alias(_V)).where(F.col(_V).isNotNull())
    size, cuts = _sketch(values, probabilities, accuracy)
    if not size:
        return [None] * len(probabilities)

    places = [_place(p, size, discrete) for p in probabilities]
    ranks = {rank: rank for low, _ in places for rank in (low, min(low + 1, size - 1))}
    found: dict[int, float] = {}
    large = [(_Range(None, None, size, ranks), cuts)]
    small: list[_Range] = []
    while large:
        wanted, cuts = large.pop()
        if wanted.size <= sorted_in_one_task:
            small.append(wanted)
            continue
        if cuts is None:
            inside = [rank / wanted.size for rank in wanted.ranks]
            _, cuts = _sketch(values.where(wanted.holds()), inside, accuracy)
        large += [(part, None) for part in _narrow(values, wanted, cuts, found)]
    found.update(_sorted_values(values, small))

    quantiles = []
    for low, weight in places:
        value = found[low]
        if weight:
            value += (found[low + 1] - value) * weight
        quantiles.append(value)
    return quantiles


def weighted_quantiles(
    df: DataFrame,
    column: str,
    weight: str,
    probabilities: Sequence[float],
    *,
    discrete: bool = False,
    sorted_in_one_task: int = SORTED_IN_ONE_TASK,
    cuts_each: int = CUTS_EACH,
) -> list:
    """``exact_quantiles`` of values that come with their numbers of occurrences.

    Equal values are merged first.  Cuts at every ``1 / cuts_each`` of the different values, from a sketch,
    part them into ranges; the summed weights tell which range holds a rank, and only a range of few
    values is put in order, with running sums, in one task.
    """
    if has_radix_key(df.schema[column].dataType):
        return radix_quantiles(df, column, probabilities, discrete=discrete, weight=weight)
    values = df.select(F.col(column).cast("double").alias(_V), F.col(weight).cast("long").alias("_w")).where(F.col(_V).isNotNull() & (F.col("_w") > 0))
    values = values.groupBy(_V).agg(F.sum("_w").alias("_w"))
    row = values.agg(F.sum("_w").alias("size"), F.count(F.lit(1)).alias("entries")).first()
    if not row["size"]:
        return [None] * len(probabilities)
    size = row["size"]
    places = [_place(p, size, discrete) for p in probabilities]
    found: dict[int, float] = {}
    # Ranges above their low and up to their high value: weight below, different values, ranks wanted.
    ranks = sorted({rank for low, _ in places for rank in (low, min(low + 1, size - 1))})
    ranges = [(None, None, 0, row["entries"], ranks)]
    while ranges:
        low, high, below, entries, wanted = ranges.pop()
        inside = values.where((F.lit(True) if low is None else F.col(_V) > low) & (F.lit(True) if high is None else F.col(_V) <= high))
        if entries <= sorted_in_one_task:
            upto = F.sum("_w").over(Window.orderBy(_V)) + below
            asked = F.array(*[F.lit(rank).cast("long") for rank in wanted])
            hits = inside.withColumn("_upto", upto).where(F.exists(asked, lambda rank: (rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_w"))))
            for hit in hits.collect():
                found.update({rank: hit[_V] for rank in wanted if hit["_upto"] - hit["_w"] <= rank < hit["_upto"]})
            continue
        grid = [k / cuts_each for k in range(1, cuts_each)]
        cuts = sorted(set(inside.agg(F.percentile_approx(_V, grid, SKETCH_ACCURACY).alias("cuts")).first()["cuts"]))
        passed = F.size(F.filter(F.array(*[F.lit(cut) for cut in cuts]), lambda cut: cut < F.col(_V)))
        for part in inside.groupBy(passed.alias("k")).agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n")).orderBy("k").collect():
            mine = [rank for rank in wanted if below <= rank < below + part["w"]]
            if mine:
                bounds = (cuts[part["k"] - 1] if part["k"] else low, cuts[part["k"]] if part["k"] < len(cuts) else high)
                ranges.append((*bounds, below, part["n"], mine))
            below += part["w"]
    return [found[low] + ((found[low + 1] - found[low]) * share if share else 0) for low, share in places]


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01
) -> list[float | None]:
    """Quantiles whose rank is off by at most ``relative_error`` (runs one job)."""
    accuracy = max(1, math.ceil(1 / relative_error))
    found = df.agg(
        F.percentile_approx(F.col(column).cast("double"), list(probabilities), accuracy).alias("found")
    ).first()["found"]
    return found if found is not None else [None] * len(probabilities)


def _place(probability: float, size: int, discrete: bool) -> tuple[int, float]:
    """Rank below the quantile, and the weight of the value one rank above."""
    if discrete:
        return max(math.ceil(probability * size), 1) - 1, 0.0
    position = probability * (size - 1)
    return math.floor(position), position - math.floor(position)


def _sketch(values: DataFrame, probabilities: Sequence[float], accuracy: int) -> tuple[int, list[float]]:
    """Number of values, and cut values that most likely enclose the quantiles."""
    margin = 2 / accuracy
    wanted = sorted({min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)})
    row = values.agg(
        F.count(F.lit(1)).alias("size"), F.percentile_approx(_V, wanted, accuracy).alias("cuts")
    ).first()
    return row["size"], sorted(set(row["cuts"] or []))


def _narrow(
    values: DataFrame, wanted: _Range, cuts: Sequence[float], found: dict[int, float]
) -> list[_Range]:
    """Settle the ranks that fall on a cut; give back the gaps that hold the others."""
    row = values.where(wanted.holds()).agg(
        *[F.count_if(F.col(_V) < cut).alias(f"below_{i}") for i, cut in enumerate(cuts)],
        *[F.count_if(F.col(_V) == cut).alias(f"at_{i}") for i, cut in enumerate(cuts)],
    ).first()
    below = [row[f"below_{i}"] for i in range(len(cuts))]
    through = [row[f"below_{i}"] + row[f"at_{i}"] for i in range(len(cuts))]

    gaps: dict[int, dict[int, int]] = {}
    for rank, overall_rank in wanted.ranks.items():
        passed = bisect_right(below, rank)  # number of cuts at or below the rank
        if passed and rank < through[passed - 1]:
            found[overall_rank] = cuts[passed - 1]
        else:
            start = through[passed - 1] if passed else 0
            gaps.setdefault(passed, {})[rank - start] = overall_rank

    return [
        _Range(
            cuts[passed - 1] if passed else wanted.low,
            cuts[passed] if passed < len(cuts) else wanted.high,
            (below[passed] if passed < len(cuts) else wanted.size) - (through[passed - 1] if passed else 0),
            ranks,
        )
        for passed, ranks in gaps.items()
    ]


def _sorted_values(values: DataFrame, ranges: Sequence[_Range]) -> dict[int, float]:
    """Sort the values of ranges that were counted to be small, all in one pass."""
    if not ranges:
        return {}
    anywhere = reduce(operator.or_, [part.holds() for part in ranges])
    ordered = [
        F.sort_array(F.collect_list(F.when(part.holds(), F.col(_V)))).alias(f"range_{i}")
        for i, part in enumerate(ranges)
    ]
    row = values.where(anywhere).agg(*ordered).select(
        *[
            F.get(f"range_{i}", F.lit(rank)).alias(str(overall_rank))
            for i, part in enumerate(ranges)
            for rank, overall_rank in part.ranks.items()
        ]
    ).first()
    return {int(name): value for name, value in row.asDict().items()}
