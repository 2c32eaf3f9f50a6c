"""Exact order statistics of whole numbers, dates and decimals by radix selection.

A value becomes an order-preserving key of 16-bit digits: four for 64 bits, up to nine for
decimals of 38 places.  Nothing goes through floating point.  One aggregate finds the number of
values and the least and the largest key; the digits these two share are skipped.  Every further
round counts the values of one digit within the prefixes that hold a wanted rank, at
most 2**16 bins a prefix, adds the counts up in order and gives back the one bin per rank
that holds it.  So a rank is settled in at most as many rounds as there are digits, whatever the number of rows,
and only bins travel, counted in every task first.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from decimal import Context, Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from storelens.operators.layout import written

DIGIT = 16
#: A wide decimal's unscaled value is cut into three numbers of this many places, the first one signed.
LIMB_PLACES = 13
LIMB_DIGITS = 3
MORE_PLACES = 6

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EPOCH = datetime.date(1970, 1, 1)


def has_radix_key(kind: T.DataType) -> bool:
    return isinstance(kind, (*_WHOLE, T.DateType, T.DecimalType))


def quantile_type(kind: T.DataType, discrete: bool) -> T.DataType:
    """Type of a quantile: the column's own if ``discrete``, else with ``MORE_PLACES`` more decimal places."""
    if discrete or isinstance(kind, T.DateType):
        return kind
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, min(38 - (kind.precision - kind.scale), kind.scale + MORE_PLACES))
    return T.DecimalType(38, MORE_PLACES) if isinstance(kind, _WHOLE) else T.DoubleType()


def radix_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], *, discrete: bool = False, weight: str | None = None
) -> list:
    """Quantiles of the non-null values (one job for their range and one per digit).

    Between two values the result is interpolated in whole numbers and rounded half to even to the
    places of ``quantile_type``, or with ``discrete`` and for dates it is the lower of them that covers the
    probability.  Probabilities are taken as the decimals they are written as.  With ``weight`` a row counts as
    often as that column says.  An empty column gives nulls.
    """
    kind = df.schema[column].dataType
    discrete = discrete or isinstance(kind, T.DateType)
    if not has_radix_key(kind):
        raise ValueError(f"{column} has no radix key: {kind.simpleString()}")
    digits, decode = _key(F.col(f"`{column}`"), kind)
    names = [f"d{k}" for k in range(len(digits))]
    count = F.lit(1).cast("long") if weight is None else F.col(f"`{weight}`").cast("long")
    keyed = df.where(F.col(f"`{column}`").isNotNull()).select(*[d.alias(n) for d, n in zip(digits, names, strict=True)], count.alias("n")).where("n > 0")
    if len(names) > 4:
        # Digits of wide decimals come from text: cut them once, not in every round.
        keyed = written(keyed, "digits")
    row = keyed.agg(F.sum("n").alias("size"), F.min(F.struct(*names)).alias("least"), F.max(F.struct(*names)).alias("most")).first()
    if not row["size"]:
        return [None] * len(probabilities)
    size = row["size"]

    places = [_place(Fraction(repr(float(p))), size, discrete) for p in probabilities]
    ranks = sorted({rank for low, weighted in places for rank in ((low, low + 1) if weighted else (low,))})
    shared = 0
    while shared < len(names) and row["least"][shared] == row["most"][shared]:
        shared += 1
    # By prefix: the wanted ranks within it, and those among all values.
    wanted: dict[tuple[int, ...], dict[int, int]] = {tuple(row["least"][:shared]): {rank: rank for rank in ranks}}
    for level in range(shared, len(names)):
        wanted = _next_digit(keyed, names, level, shared, wanted)
    found = {rank: decode(prefix) for prefix, inside in wanted.items() for rank in inside.values()}

    if discrete:
        return [_of_type(found[low], kind) for low, _ in places]
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    result = quantile_type(kind, False)
    return [_rounded(found[low] + ((found[low + 1] - found[low]) * weighted if weighted else 0), scale, result.scale) for low, weighted in places]


def _place(probability: Fraction, size: int, discrete: bool) -> tuple[int, Fraction]:
    """Rank below the quantile, and the weight of the value one rank above."""
    if discrete:
        return max(math.ceil(probability * size), 1) - 1, Fraction(0)
    position = probability * (size - 1)
    return math.floor(position), position - math.floor(position)


def _next_digit(keyed: DataFrame, names: list[str], level: int, shared: int, wanted: dict) -> dict:
    """The wanted ranks by prefixes that are one digit longer (one job; gives back at most one bin per rank)."""
    held = names[shared:level]
    ranks = {prefix: F.array(*[F.lit(r).cast("long") for r in inside]) for prefix, inside in wanted.items()}
    small = None
    if held:
        # As many rows as prefixes, which are no more than the wanted ranks.
        entries = [
            F.struct(*[F.lit(prefix[shared + k]).cast("int").alias(name) for k, name in enumerate(held)], inside.alias("ranks"))
            for prefix, inside in ranks.items()
        ]
        small = F.broadcast(keyed.sparkSession.range(0, 1, numPartitions=1).select(F.inline(F.array(*entries))))
    counted = keyed.join(small.select(*held), held, "left_semi") if held else keyed
    bins = counted.groupBy(*held, names[level]).agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*held).orderBy(names[level]))
    placed = bins.withColumn("below", upto - F.col("n"))
    placed = placed.join(small, held) if held else placed.withColumn("ranks", next(iter(ranks.values())))
    hit = placed.where(F.exists("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n"))))
    longer: dict[tuple[int, ...], dict[int, int]] = {}
    for row in hit.collect():
        prefix = next(iter(wanted))[:shared] + tuple(row[name] for name in held)
        inside = {rank - row["below"]: overall for rank, overall in wanted[prefix].items() if row["below"] <= rank < row["below"] + row["n"]}
        longer[(*prefix, row[names[level]])] = inside
    return longer


def _digits(value: Column, count: int) -> list[Column]:
    """16-bit digits of a bigint, the first one signed."""
    mask = F.lit((1 << DIGIT) - 1).cast("long")
    shifted = [F.shiftright(value, DIGIT * k) if k else value for k in range(count - 1, -1, -1)]
    return [(part if k == 0 else part.bitwiseAND(mask)).cast("int") for k, part in enumerate(shifted)]


def _joined(digits: Sequence[int]) -> int:
    value = digits[0]
    for digit in digits[1:]:
        value = (value << DIGIT) + digit
    return value


def _key(value: Column, kind: T.DataType):
    """The digits of a column, and a function from digits to the whole number they stand for."""
    if isinstance(kind, T.DateType):
        return _digits(F.unix_date(value).cast("long"), 2), _joined
    if not isinstance(kind, T.DecimalType):
        return _digits(value.cast("long"), 4), _joined
    if kind.precision <= 18:
        return _digits((value * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long") if kind.scale else value.cast("long"), 4), _joined
    # The digits of the text hold the unscaled value exactly; a cast that may fail writes them without exponents in every mode, and
    # arithmetic or comparison with another type would round.
    text = value.try_cast("string")
    padded = F.lpad(F.regexp_replace(text, "[-.]", ""), 3 * LIMB_PLACES, "0")
    limbs = [F.substring(padded, 1 + k * LIMB_PLACES, LIMB_PLACES).cast("long") for k in range(3)]
    sign = F.when(text.startswith("-"), -1).otherwise(1).cast("long")
    digits = [d for limb in limbs for d in _digits(limb * sign, LIMB_DIGITS)]

    def decode(parts: Sequence[int]) -> int:
        first, second, third = (_joined(parts[k * LIMB_DIGITS : (k + 1) * LIMB_DIGITS]) for k in range(3))
        return (first * 10**LIMB_PLACES + second) * 10**LIMB_PLACES + third

    return digits, decode


def _of_type(value: int, kind: T.DataType):
    if isinstance(kind, T.DateType):
        return _EPOCH + datetime.timedelta(days=value)
    return Decimal(value).scaleb(-kind.scale, Context(prec=60)) if isinstance(kind, T.DecimalType) else value


def _rounded(value: int | Fraction, scale: int, places: int) -> Decimal:
    """``value / 10**scale`` with so many places, half to even."""
    return Decimal(round(Fraction(value) * 10 ** (places - scale))).scaleb(-places, Context(prec=60))
