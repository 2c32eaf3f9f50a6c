from __future__ import annotations

import pandas as pd
import pytest

from pyspark.sql import functions as F

from storelens.operators import profile


@pytest.fixture(scope="module")
def prices(spark):
    rows = [("a", 1.0, 4.0), ("b", 2.0, None), ("a", None, 1.0), ("c", 8.0, 0.5), (None, 3.0, 9.0)]
    return spark.createDataFrame(rows, "k string, price double, other double")


def test_null_percents(prices):
    assert profile.null_percents(prices).first().asDict() == {"k": 20.0, "price": 20.0, "other": 20.0}
    long = {row["column"]: row["null_percent"] for row in profile.null_percents_long(prices).collect()}
    assert long == {"k": 20.0, "price": 20.0, "other": 20.0}


def test_null_percents_of_empty_table(prices):
    assert profile.null_percents(prices.limit(0)).first().asDict() == {"k": None, "price": None, "other": None}


def test_column_statistics_and_description(prices):
    series = pd.Series([1.0, 2.0, 8.0, 3.0])
    expected = {"mean": series.mean(), "std": series.std(), "min": 1.0, "max": 8.0, "median": series.median()}
    assert profile.column_statistics(prices, "price").first().asDict() == pytest.approx(expected)

    described = profile.describe_column(prices, "price").first().asDict()
    assert list(described.values()) == pytest.approx(series.describe().tolist())


def test_approximate_statistics_stay_in_range(prices):
    row = profile.column_statistics(prices, "price", approximate=True).first()
    assert row["median"] in (2.0, 3.0)


@pytest.mark.parametrize("values, std", [([], None), ([None], None), ([5.0], None), ([5.0, 5.0], 0.0)])
def test_statistics_of_few_values(spark, values, std):
    df = spark.createDataFrame([(v,) for v in values], "price double")
    row = profile.column_statistics(df, "price").first()
    present = [v for v in values if v is not None]
    assert row["std"] == std
    assert row["median"] == row["mean"] == (5.0 if present else None)


def test_correlation_matrix_is_pairwise_complete(prices):
    pandas = prices.toPandas()[["price", "other"]].corr()
    for row in profile.correlation_matrix(prices, ["price", "other"]).collect():
        assert row["corr"] == pytest.approx(pandas.loc[row["x"], row["y"]])


def test_value_counts(prices):
    assert [tuple(row) for row in profile.value_counts(prices, "k").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    packed = profile.value_counts_map(prices, "k").first()["k"]
    assert list(packed.items()) == [("a", 2), ("b", 1), ("c", 1)]


def test_value_counts_map_takes_any_number_of_values(spark):
    rows = spark.range(40_000).select((F.col("id") % 20_000).cast("string").alias("k"))
    packed = profile.value_counts_map(rows, "k").first()["k"]
    assert len(packed) == 20_000 and set(packed.values()) == {2}


def test_distinct_values(prices):
    assert {row["k"] for row in profile.distinct_values(prices, "k").collect()} == {"a", "b", "c"}
