from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from storelens.operators.quantiles import approximate_quantiles, exact_quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("limit", [1, 3, 1_000])
@pytest.mark.parametrize(
    "values",
    [
        [5],
        [1, 2],
        [7] * 50,
        [1] * 40 + [2] * 40,
        list(range(101)),
        [3, 1, 2, None, None],
        [0] * 100 + list(range(60)) + [59] * 100,
    ],
)
def test_exact(spark, values, limit):
    present = [v for v in values if v is not None]
    df = frame(spark, values)
    found = exact_quantiles(df, "x", PROBABILITIES, sorted_in_one_task=limit, accuracy=20)
    assert found == pytest.approx([float(np.percentile(present, p * 100)) for p in PROBABILITIES])
    discrete = exact_quantiles(df, "x", PROBABILITIES, discrete=True, sorted_in_one_task=limit, accuracy=20)
    assert discrete == [
        float(np.percentile(present, p * 100, method="inverted_cdf")) for p in PROBABILITIES
    ]


def test_empty_column(spark):
    assert exact_quantiles(frame(spark, [None]), "x", [0.5, 0.9]) == [None, None]
    assert approximate_quantiles(frame(spark, [None]), "x", [0.5]) == [None]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.0]), min_size=1, max_size=200),
    st.floats(0, 1),
)
def test_narrowing_equals_sorting(spark, values, probability):
    found = exact_quantiles(frame(spark, values), "x", [probability], sorted_in_one_task=5, accuracy=10)
    assert found == pytest.approx([float(np.percentile(values, probability * 100))])


def test_many_rows_are_narrowed(spark):
    df = spark.range(0, 200_001).selectExpr("cast((id * 7919) % 200001 as double) as x")
    found = exact_quantiles(df, "x", [0.5, 0.25], sorted_in_one_task=2_000, accuracy=1_000)
    assert found == [100_000.0, 50_000.0]


def test_approximate_rank(spark):
    df = spark.range(0, 10_001).selectExpr("cast(id as double) as x")
    (found,) = approximate_quantiles(df, "x", [0.5], 0.01)
    assert abs(found - 5_000) <= 100
