from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storelens.operators import integrity


@pytest.fixture(scope="module")
def parents(spark):
    return spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "asin string")


@pytest.fixture(scope="module")
def children(spark):
    return spark.createDataFrame([("1", 5.0), ("9", 1.0), (None, 2.0), ("9", 3.0), ("2", 4.0)], "asin string, v double")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_marks_keep_every_row(children, parents):
    marked = integrity.match_marks(children, parents, "asin")
    assert {(row["v"], row["matched"]) for row in marked.collect()} == {
        (5.0, True), (1.0, False), (2.0, False), (3.0, False), (4.0, True),
    }
    assert marked.count() == 5


def test_dangling(children, parents):
    assert rows(integrity.dangling_rows(children, parents, "asin")) == [("9", 1.0), ("9", 3.0)]
    assert rows(integrity.dangling_keys(children, parents, "asin")) == [("9", 2)]
    assert rows(integrity.key_difference(children, parents, "asin")) == [("9",)]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_flag(children, parents, limit):
    def flag(df):
        frame = integrity.dangling_flag(df, parents, "asin", broadcast_bytes=limit)
        found = integrity.has_dangling(df, parents, "asin", broadcast_bytes=limit)
        assert frame.first()["dangling"] == int(found)
        return found

    assert flag(children)
    assert not flag(children.where("asin <> '9'"))
    assert not flag(children.where("asin is null"))
    assert not flag(children.limit(0))


def test_no_parents(children, parents):
    assert integrity.has_dangling(children, parents.limit(0), "asin")


def test_listed_keys(spark):
    df = spark.createDataFrame([(["1", None, "9"],), ([],), (None,)], "ids array<string>")
    assert rows(integrity.listed_keys(df, F.col("ids"), "asin")) == [("1",), ("9",)]


keys = st.lists(st.sampled_from("abcdef") | st.none(), max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys, keys)
def test_flags_agree_with_sets(spark, left, right):
    a, b = (spark.createDataFrame([(k,) for k in side], "asin string") for side in (left, right))
    missing = set(left) - set(right) - {None}
    assert {row["asin"] for row in integrity.key_difference(a, b, "asin").collect()} == missing
    assert {row["asin"]: row["n"] for row in integrity.dangling_keys(a, b, "asin").collect()} == {
        k: left.count(k) for k in missing
    }
    assert integrity.has_dangling(a, b, "asin") is bool(missing)
    marks = integrity.match_marks(a, b, "asin").collect()
    assert len(marks) == len(left)
    assert all(row["matched"] == (row["asin"] is not None and row["asin"] in right) for row in marks)


def test_a_find_ends_the_scan(spark):
    """Every row is dangling: the first of 64 partitions is enough."""
    children = spark.range(0, 64_000, numPartitions=64).selectExpr("cast(id as string) as asin")
    parents = spark.createDataFrame([("none",)], "asin string")

    def tasks(found):
        context = spark.sparkContext
        context.setJobGroup(found, found)
        flag = integrity.early_dangling_flag(children, parents, "asin").first()[0]
        context.setJobGroup("other", "other")
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(found) for s in tracker.getJobInfo(j).stageIds]
        return flag, sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))

    flag, started = tasks("some")
    assert flag == 1 and started < 30
