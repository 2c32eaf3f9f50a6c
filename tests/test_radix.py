"""Exact quantiles of whole numbers, decimals and dates."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal
from fractions import Fraction

import pytest

from storelens.operators import radix
from storelens.operators.profile import column_statistics, describe_column, weighted_statistics
from storelens.operators.quantiles import exact_quantiles, weighted_quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def lower(values, p):
    ordered = sorted(values)
    return ordered[max(-(-Fraction(repr(p)) * len(ordered) // 1), 1) - 1]


def middle(values, p, places):
    ordered = [Fraction(v) for v in sorted(values)]
    position = Fraction(repr(p)) * (len(ordered) - 1)
    at = int(position)
    value = ordered[at] + ((ordered[at + 1] - ordered[at]) * (position - at) if position > at else 0)
    return Decimal(round(value * 10**places)).scaleb(-places)


def test_middle_beyond_the_reach_of_doubles(spark):
    df = spark.createDataFrame([(2**53 + k,) for k in (5, 1, 3)], "k bigint")
    assert exact_quantiles(df, "k", [0.5]) == [Decimal(2**53 + 3)]
    row = column_statistics(df, "k").first()
    assert row["median"] == 2**53 + 3
    assert describe_column(df, "k").first()["q25"] == 2**53 + 2


WHOLE = {
    "spread": [-(2**63), 2**63 - 1, 0, -1, 1, 2**62, -(2**62), 7, 7],
    "one": [5],
    "shifted": [2**60 + (k * 7919) % 1000 for k in range(500)],
    "many equal": [3] * 200 + [4] * 3 + [-9] * 5,
    "random": [random.Random(k).randint(-(2**40), 2**40) for k in range(400)],
}


@pytest.mark.parametrize("name", WHOLE)
def test_whole_numbers(spark, name):
    values = WHOLE[name]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "k bigint").repartition(3)
    assert exact_quantiles(df, "k", PROBABILITIES, discrete=True) == [lower(values, p) for p in PROBABILITIES]
    assert exact_quantiles(df, "k", PROBABILITIES) == [middle(values, p, 6) for p in PROBABILITIES]


@pytest.mark.parametrize("kind", ["decimal(9,2)", "decimal(18,18)", "decimal(38,0)", "decimal(38,38)", "decimal(30,12)"])
def test_decimals(spark, kind):
    precision, scale = map(int, kind[8:-1].split(","))
    rng = random.Random(precision + scale)
    units = [rng.randint(-(10**precision) + 1, 10**precision - 1) for _ in range(60)] + [0, 1, -1, 10**precision - 1, 1 - 10**precision, 10 ** (precision // 2)]
    df = spark.createDataFrame([(Decimal(u).scaleb(-scale),) for u in units], f"k {kind}") if precision < 28 else (
        spark.createDataFrame([(f"{'-' if u < 0 else ''}0.{abs(u):038d}" if scale == 38 else f"{u}e-{scale}",) for u in units], "t string").selectExpr(f"cast(t as {kind}) as k")
    )
    found = exact_quantiles(df, "k", PROBABILITIES, discrete=True)
    assert [int(v.scaleb(scale, __import__("decimal").Context(prec=60))) for v in found] == [lower(units, p) for p in PROBABILITIES]


def test_decimals_without_ansi_text(spark):
    """Zero and tiny values must not turn into exponents on the way."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = spark.createDataFrame([("0",), ("0.00000000000000000001",), ("-0.00000000000000000003",)], "t string").selectExpr("cast(t as decimal(38,20)) as k")
        assert exact_quantiles(df, "k", [0.0, 0.5, 1.0], discrete=True) == [Decimal("-3E-20"), Decimal("0E-20"), Decimal("1E-20")]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_dates_and_empty_columns(spark):
    days = [datetime.date(1969, 12, 30), datetime.date(2024, 2, 29), datetime.date(1, 1, 1), None, datetime.date(1970, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert exact_quantiles(df, "d", [0.5, 1.0]) == [datetime.date(1969, 12, 30), datetime.date(2024, 2, 29)]
    assert exact_quantiles(df.where("d is null"), "d", [0.5]) == [None]
    assert not radix.has_radix_key(spark.range(1).selectExpr("1.5d as x").schema["x"].dataType)


def test_weights_stand_for_rows(spark):
    values = {k * k - 40: 1 + k % 7 for k in range(60)}
    plain = [v for v, n in values.items() for _ in range(n)]
    rows = [(v, n) for v, n in values.items()] + [(None, 5), (10**6, 0)]
    whole = spark.createDataFrame(rows, "v bigint, n bigint")
    assert radix.radix_quantiles(whole, "v", PROBABILITIES, weight="n") == [middle(plain, p, 6) for p in PROBABILITIES]
    floating = whole.selectExpr("cast(v as double) as v", "n")
    wanted = exact_quantiles(spark.createDataFrame([(float(v),) for v in plain], "v double"), "v", PROBABILITIES)
    for limit in (1, 10, 1000):
        assert weighted_quantiles(floating, "v", "n", PROBABILITIES, sorted_in_one_task=limit, cuts_each=4) == pytest.approx(wanted)
    assert weighted_quantiles(floating.where("v is null"), "v", "n", [0.5]) == [None]


def test_weighted_statistics(spark):
    rows = [(1e9 + k % 5, 1 + k % 3) for k in range(40)]
    weighted = spark.createDataFrame(rows, "v double, n bigint")
    plain = spark.createDataFrame([(v,) for v, n in rows for _ in range(n)], "v double")
    assert weighted_statistics(weighted, "v", "n").first().asDict() == pytest.approx(column_statistics(plain, "v").first().asDict())
    one = spark.createDataFrame([(2.0, 1)], "v double, n bigint")
    assert weighted_statistics(one, "v", "n").first()["std"] is None
    assert weighted_statistics(one.where("v > 5"), "v", "n").first().asDict() == {"mean": None, "std": None, "min": None, "max": None, "median": None}
