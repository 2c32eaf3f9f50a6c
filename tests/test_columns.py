from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelens.functions import columns as C
from storelens.functions import stats
from storelens.functions.text import tokens


def values(df, *columns):
    return [tuple(row) if len(columns) > 1 else row[0] for row in df.select(*columns).collect()]


def test_blank_and_label(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",), ("unknown",)], "t string")
    assert values(df, C.blank_to_null(F.col("t"))) == ["a", None, None, " ", "unknown"]
    assert values(df, C.label_if_blank(F.col("t"), "unknown")) == ["a", "unknown", "unknown", " ", "unknown"]


def test_to_float_is_single_precision_and_never_raises(spark):
    df = spark.createDataFrame([("9.99",), ("x",), ("",), (None,)], "p string")
    assert values(df, C.to_float(F.col("p")).cast("double")) == [pytest.approx(9.98999977, abs=1e-8), None, None, None]


def test_fill_null_without_substitute(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "p float")
    assert values(df, C.fill_null(F.col("p"), 2.25)) == [1.5, 2.25]
    assert values(df, C.fill_null(F.col("p"), None)) == [1.5, None]


def test_first_entry_of_map(spark):
    df = spark.createDataFrame([({"Books": 3},), ({},), (None,)], "m map<string,int>")
    assert values(df, C.first_key(F.col("m")), C.first_value(F.col("m"))) == [("Books", 3), (None, None), (None, None)]


def test_first_of_first(spark):
    rows = [([["a", "b"], ["c"]],), ([[""]],), ([[]],), ([],), (None,), ([None],), ([[None]],)]
    df = spark.createDataFrame(rows, "c array<array<string>>")
    assert values(df, C.first_of_first(F.col("c"))) == ["a"] + [None] * 6


def test_has_items_and_concat(spark):
    df = spark.createDataFrame([(["a"], ["b", "a"]), ([], None), (None, None)], "x array<string>, y array<string>")
    assert values(df, C.has_items(F.col("x"))) == [True, False, False]
    assert values(df, C.concat_lists([F.col("x"), F.col("y")])) == [["a", "b", "a"], [], []]
    assert df.select(C.concat_lists([F.col("x")]).alias("c")).schema["c"].dataType.elementType.typeName() == "string"


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([], None),
        ([(1.0, 2.0)], None),
        ([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], None),
        ([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], 1.0),
        ([(1.0, 2.0), (2.0, 4.0), (9.0, None), (None, 9.0), (3.0, 1.0)], -0.32732683535),
    ],
)
def test_pearson(spark, rows, expected):
    df = spark.createDataFrame(rows, "x double, y double")
    result = df.agg(stats.pearson(F.col("x"), F.col("y"))).first()[0]
    assert result == (None if expected is None else pytest.approx(expected))


def test_null_percent_of_empty_table(spark):
    assert spark.createDataFrame([], "x int").agg(stats.null_percent(F.col("x"))).first()[0] is None


def test_root_mean_square(spark):
    df = spark.createDataFrame([(3.0,), (-4.0,), (None,)], "e double")
    assert df.agg(stats.root_mean_square(F.col("e"))).first()[0] == pytest.approx(math.sqrt(12.5))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=40))
def test_tokens_split_like_python(spark, texts):
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, t string")
    split = dict(map(tuple, df.select("i", F.filter(F.split("t", r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")).collect()))
    assert split == {i: text.split() for i, text in enumerate(texts)}


def test_tokens(spark):
    spaced = "A b C​d\x1ce\x85f　 "
    df = spark.createDataFrame([(" The  CAT ",), ("",), (None,), (spaced,), ("  ",)], "t string")
    assert values(df, tokens(F.col("t"))) == [["the", "cat"], [], [], spaced.lower().split(), []]
