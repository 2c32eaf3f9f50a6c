from __future__ import annotations

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from storelens.operators import features
from storelens.plans import tasks


def by_key(df, *names):
    return {row["asin"]: tuple(row[name] for name in names) for row in df.collect()}


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [("1", 5.0), ("1", 3.0), ("2", None), ("7", 1.0), (None, 2.0), ("1", None)]
    return spark.createDataFrame(rows, "asin string, overall double")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("1", 10.0), ("2", 20.0), ("3", None), (None, 5.0)], "asin string, price double")


def test_rating_features(reviews, products):
    rated = features.rating_features(products, reviews)
    assert by_key(rated, "meanRating", "countRating") == {
        "1": (4.0, 2), "2": (None, 0), "3": (None, None), None: (None, None),
    }
    row = tasks.task_1(reviews, products).first()
    assert row.asDict() == {
        "count_total": 4,
        "mean_meanRating": 4.0, "variance_meanRating": None, "numNulls_meanRating": 3,
        "mean_countRating": 1.0, "variance_countRating": 2.0, "numNulls_countRating": 2,
    }


def test_repeated_product_keys_are_kept(reviews, products):
    doubled = features.rating_features(products.unionByName(products), reviews)
    assert doubled.count() == 8
    assert doubled.where("meanRating = 4.0").count() == 2


def test_rated_prices(reviews, products):
    assert sorted(map(tuple, features.rated_prices(reviews, products).collect())) == [("1", 3.0, 10.0), ("1", 5.0, 10.0)]


def test_category_features(spark):
    schema = "asin string, categories array<array<string>>, salesRank map<string,int>"
    rows = [
        ("1", [["Books", "Novels"]], {"Books": 7, "Toys": 1}),
        ("2", [[""]], {}),
        ("3", [], None),
        ("4", [[]], {"Toys": None}),
        ("5", None, {"Toys": 9}),
    ]
    df = spark.createDataFrame(rows, schema)
    assert by_key(features.category_features(df), "category", "bestSalesCategory", "bestSalesRank") == {
        "1": ("Books", "Books", 7), "2": (None, None, None), "3": (None, None, None),
        "4": (None, "Toys", None), "5": (None, "Toys", 9),
    }
    row = tasks.task_2(df).first()
    assert row.asDict() == {
        "count_total": 5, "mean_bestSalesRank": 8.0, "variance_bestSalesRank": 2.0,
        "numNulls_category": 4, "countDistinct_category": 1,
        "numNulls_bestSalesCategory": 2, "countDistinct_bestSalesCategory": 2,
    }


VIEWED = "asin string, price double, related struct<also_viewed:array<string>>"


def test_related_features(spark):
    rows = [
        ("1", 10.0, (["2", "3", "99", None],)),
        ("2", 20.0, ([],)),
        ("3", None, (None,)),
        ("4", 40.0, (["3", "98"],)),
        ("5", 50.0, None),
        ("6", 60.0, ([None],)),
        (None, 70.0, (["1"],)),
    ]
    viewed = features.related_features(spark.createDataFrame(rows, VIEWED))
    assert by_key(viewed, "meanPriceAlsoViewed", "countAlsoViewed") == {
        "1": (20.0, 3), "2": (None, None), "3": (None, None), "4": (None, 2),
        "5": (None, None), "6": (None, 0), None: (None, None),
    }


def test_related_features_of_a_map(spark):
    schema = "asin string, price double, related map<string,array<string>>"
    df = spark.createDataFrame([("1", 1.0, {"also_viewed": ["1", "2"]}), ("2", 3.0, {})], schema)
    assert by_key(features.related_features(df), "meanPriceAlsoViewed", "countAlsoViewed") == {
        "1": (2.0, 2), "2": (None, None),
    }


def test_related_prices(spark):
    rows = [("1", 10.0, (["2", "9", None],)), ("2", 20.0, ([],)), ("2", 25.0, None)]
    found = features.related_prices(spark.createDataFrame(rows, VIEWED))
    assert found.columns == ["asin", "also_viewed_asin", "price"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("1", "2", 20.0), ("1", "2", 25.0), ("1", "9", None), ("1", None, None), ("2", None, None), ("2", None, None)],
        key=str,
    )


ids = st.sampled_from(["1", "2", "3", "4"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(ids, st.integers(1, 9) | st.none(), st.lists(ids | st.none(), max_size=4) | st.none()), min_size=1, max_size=8))
def test_related_features_equal_the_joined_rows(spark, rows):
    """With repeated keys on both sides the sums carried along equal a plain join."""
    data = [(asin, None if price is None else float(price), (listed,)) for asin, price, listed in rows]
    got = sorted(
        ((row["asin"], row["meanPriceAlsoViewed"], row["countAlsoViewed"]) for row in
         features.related_features(spark.createDataFrame(data, VIEWED)).collect()), key=str)

    expected = []
    for asin, _, listed in rows:
        if not listed:
            expected.append((asin, None, None))
            continue
        joined = []
        for other, _, items in rows:
            for item in items or [] if other == asin else []:
                if item is not None:
                    joined.extend([price for key, price, _ in rows if key == item] or [None])
        priced = [price for price in joined if price is not None]
        expected.append((asin, sum(priced) / len(priced) if priced else None, len(joined)))
    assert len(got) == len(expected)
    for mine, theirs in zip(got, sorted(expected, key=str), strict=True):
        assert mine[0] == theirs[0] and mine[2] == theirs[2]
        assert mine[1] == (None if theirs[1] is None else pytest.approx(theirs[1]))


def test_imputed_features(spark):
    rows = [("1", "1.5", "a"), ("2", None, None), ("3", "x", ""), ("4", "2.5", "unknown"), ("5", "8", "b")]
    df = spark.createDataFrame(rows, "asin string, price string, title string")
    imputed = by_key(features.imputed_features(df), "meanImputedPrice", "medianImputedPrice", "unknownImputedTitle")
    assert imputed == {
        "1": (1.5, 1.5, "a"), "2": (4.0, 2.5, "unknown"), "3": (4.0, 2.5, "unknown"),
        "4": (2.5, 2.5, "unknown"), "5": (8.0, 8.0, "b"),
    }
    row = tasks.task_4(df, approximate_error=0.01).first()
    assert row["count_total"] == 5
    assert row["numUnknowns_unknownImputedTitle"] == 3
    assert row["mean_meanImputedPrice"] == pytest.approx(4.0)


def test_nothing_to_impute_from(spark):
    df = spark.createDataFrame([(None, None)], "price string, title string")
    row = tasks.task_4(df).first()
    assert row["numNulls_meanImputedPrice"] == row["numNulls_medianImputedPrice"] == 1
    assert row["mean_meanImputedPrice"] is None


def correlation(spark, reviews, products):
    r = spark.createDataFrame(reviews, "asin string, overall double")
    p = spark.createDataFrame(products, "asin string, price double")
    return features.rating_price_correlation(r, p).first()["corr"]


@pytest.mark.parametrize(
    "reviews, products",
    [
        ([], []),
        ([("1", 5.0)], [("1", 2.0)]),
        ([("1", 5.0), ("2", 4.0)], [("1", 2.0), ("2", 2.0)]),
        ([("1", 0.1)] * 3 + [("2", 0.1)] * 4, [("1", 2.0), ("2", 3.0)]),
        ([("1", 5.0), ("1", None)], [("1", None), ("9", 2.0)]),
    ],
)
def test_correlation_is_null_without_spread(spark, reviews, products):
    assert correlation(spark, reviews, products) is None


def test_correlation_of_sorted_shifted_prices(spark):
    """A thousand free products without reviews come first, the others cost 1e9 and a few cents."""
    products = [(f"n{k}", 0.0) for k in range(1_100)] + [(str(k), 1e9 + k % 7 / 100) for k in range(300)]
    reviews = [(str(k), float(k % 7 + k % 3)) for k in range(300)]
    wanted = pd.Series([k % 7 for k in range(300)]).corr(pd.Series([k % 7 + k % 3 for k in range(300)]))
    assert correlation(spark, reviews, products) == pytest.approx(wanted, abs=1e-5)


number = st.integers(0, 50).map(float)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(ids | st.none(), number | st.none()), max_size=12),
    st.lists(st.tuples(ids | st.none(), number.map(lambda x: 1e5 + x) | st.none()), max_size=8),
)
def test_correlation_equals_the_joined_rows(spark, reviews, products):
    found = correlation(spark, reviews, products)
    left = pd.DataFrame(reviews, columns=["asin", "overall"]).dropna()
    right = pd.DataFrame(products, columns=["asin", "price"]).dropna()
    joined = left.merge(right, on="asin")
    x, y = joined["overall"].astype(float), joined["price"].astype(float)
    if len(joined) < 2 or x.nunique() < 2 or y.nunique() < 2:
        assert found is None
    else:
        assert found == pytest.approx(x.corr(y), abs=1e-9)
        assert not math.isnan(found)
