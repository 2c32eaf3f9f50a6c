"""Every registered query: against its SQL twin, or by its rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from storelens.plans.oracle import ORACLE
from storelens.plans.registry import QUERIES
from tests.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_same_rows_twice(spark, name):
    first = QUERIES[name](spark, SMALL)
    rows = sorted(map(tuple, first.collect()))
    assert rows
    if name != "word2vec_synonyms":  # training is not repeatable to the last digit
        assert rows == sorted(map(tuple, QUERIES[name](spark, SMALL).collect()))


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    row = contract.entry(spark).first()
    assert row["count_total"] == 200
    assert set(contract.entry(spark).columns) == {
        "count_total", "mean_meanRating", "variance_meanRating", "numNulls_meanRating",
        "mean_countRating", "variance_countRating", "numNulls_countRating",
    }
