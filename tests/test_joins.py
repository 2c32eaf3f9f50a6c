from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

from storelens.operators.joins import (
    assert_unique_key,
    frequent_keys,
    hot_keys,
    lookup_join,
    measured_bytes,
    repeated_keys,
    split_join,
    with_split,
)


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows under one key, some null keys, some keys without a match."""
    ids = spark.range(0, 30_000, numPartitions=6)
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    return ids.select(key.alias("key"), (F.col("id") % 5).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 400).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        (F.col("id") * 10).alias("w"),
    )


def counted(df):
    return collections.Counter(map(tuple, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_all_ways_agree(rows, lookup, how):
    plain = counted(rows.join(lookup, "key", how))
    assert counted(split_join(rows, lookup, "key", how, rows_per_split=700)) == plain
    assert counted(split_join(rows, lookup, "key", how)) == plain
    assert counted(split_join(rows, lookup, "key", how, rows_per_split=20, max_frequent=3)) == plain
    assert counted(lookup_join(rows, lookup, "key", how)) == plain
    assert counted(lookup_join(rows, lookup, "key", how, broadcast_bytes=0, rows_per_split=500)) == plain


def test_repeated_lookup_keys_multiply_rows_as_in_a_plain_join(rows, lookup):
    twice = lookup.unionByName(lookup.withColumn("w", F.col("w") + 1))
    assert counted(split_join(rows, twice, "key", rows_per_split=700)) == counted(rows.join(twice, "key"))


def test_hot_key_is_dealt_over_tasks(spark, rows, lookup):
    """No task of the shuffle join receives more than a small share of the rows."""
    before = {name: spark.conf.get(name) for name in
              ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")

        def largest(df):
            return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        assert largest(rows.join(lookup, "key", "left")) >= 10_000
        assert largest(split_join(rows, lookup, "key", "left", rows_per_split=500)) < 4_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_frequent_keys(rows):
    found = frequent_keys(rows, "key", 300)
    assert set(found) == {"hot", None}
    assert found["hot"] == 10_000
    assert frequent_keys(rows, "key", 20_000) == {}
    assert frequent_keys(rows.limit(0), "key", 0) == {}


def test_integer_keys_are_split_too(spark):
    left = spark.range(0, 5_000).selectExpr("if(id % 2 = 0, 7, id) as k", "id")
    right = spark.range(0, 100).selectExpr("id as k", "id * 2 as w")
    assert counted(split_join(left, right, "k", "left", rows_per_split=100)) == counted(left.join(right, "k", "left"))


def test_many_null_keys(spark):
    left = spark.range(0, 5_000).selectExpr("if(id % 2 = 0, null, id % 100) as k", "id")
    right = spark.range(0, 50).selectExpr("id as k", "id * 2 as w")
    for how in ("left", "left_anti", "inner"):
        assert counted(split_join(left, right, "k", how, rows_per_split=100)) == counted(left.join(right, "k", how))


def test_join_type_is_checked(rows, lookup):
    with pytest.raises(ValueError):
        lookup_join(rows, lookup, "key", "full")


def test_measured_bytes(spark):
    df = spark.createDataFrame([("ab", 1.0), (None, 2.0)], "a string, b double")
    assert measured_bytes(df) == 2 * (16 + 16 + 8) + 2
    assert measured_bytes(df.where("b > 5")) == 0
    with pytest.raises(ValueError):
        measured_bytes(df.select(F.array("a").alias("a")))


def test_unique_key_check(spark):
    assert_unique_key(spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string"), "k")
    doubled = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    assert [tuple(row) for row in repeated_keys(doubled, "k").collect()] == [("a", 2)]
    with pytest.raises(ValueError, match="'a' occurs 2 times"):
        assert_unique_key(doubled, "k")


def test_five_thousand_hot_keys_are_split(spark):
    left = spark.range(0, 60_000, numPartitions=5).selectExpr("id % 5000 as k", "id")
    right = spark.range(0, 5_500).selectExpr("id as k", "id * 2 as w")
    hot = hot_keys(left, "k", 10)
    assert hot.count() == 5_000 and {row["n"] for row in hot.collect()} == {12}
    for how in ("inner", "left", "left_anti"):
        assert counted(split_join(left, right, "k", how, rows_per_split=10)) == counted(left.join(right, "k", how))
    # Where the table of hot keys would be too large to send, only the larger ones are split.
    assert counted(split_join(left, right, "k", rows_per_split=3, broadcast_bytes=1_000)) == counted(left.join(right, "k"))


def test_sampled_hot_keys_are_counted_exactly(spark):
    left = spark.range(0, 100_000, numPartitions=5).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) as k")
    assert {row["k"]: row["n"] for row in hot_keys(left, "k", 2_000).collect()} == {None: 33_334, 7: 33_333}


def test_splits_do_not_depend_on_the_order_of_the_rows(spark):
    rows = [("a", k % 4, {"x": k % 2}) for k in range(50)]
    found = []
    for order in (rows, rows[::-1], sorted(rows, key=str)):
        df = spark.createDataFrame(order, "key string, v int, m map<string,int>").coalesce(1).withColumn("_splits", F.lit(3))
        found.append(collections.Counter((r["key"], r["v"], str(r["m"]), r["_split"]) for r in with_split(df).collect()))
    assert found[0] == found[1] == found[2]
    assert len({split for *_, split in found[0]}) == 3
