"""What the physical plans look like: what is read, moved and run in Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from storelens.operators import features, integrity, profile, vectors
from storelens.operators.joins import split_join
from storelens.plans import tasks
from storelens.plans.registry import QUERIES
from storelens.sources.shop_views import nested_products, products, reviews, table
from tests.conftest import SMALL

NESTED_TEXT = {
    "supercategory_counts", "profile_report", "dangling_related", "dangling_related_flag", "category_lists",
    "related_lists", "related_mentions", "also_viewed_prices", "sales_rank_features", "sales_rank_stats", "also_viewed_features", "also_viewed_stats",
}
FITTED = {"word2vec_synonyms", "brand_index", "brand_one_hot_mean", "brand_pca_mean", "tree_rmse", "tree_depth_tuning"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_nested_loops_and_no_python_where_avoidable(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert "MapInPandas" not in text
    if name not in NESTED_TEXT:
        assert "ArrowEvalPython" not in text


def test_only_needed_columns_are_read(spark):
    lineitem = table(spark, SMALL, "lineitem")
    text = plan(profile.column_statistics(lineitem, "l_tax"))
    assert re.search(r"ReadSchema: struct<l_tax:double>", text)
    text = plan(features.rating_features(products(spark, SMALL), reviews(spark, SMALL)))
    assert "l_suppkey" not in text
    assert "p_name" not in text


def test_filters_reach_the_scan(spark):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    text = plan(integrity.dangling_rows(documents.select("doc_id"), labels, "doc_id"))
    assert "PushedFilters: [IsNotNull(doc_id)]" in text
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_small_parents_are_broadcast_and_reviews_stay(spark):
    text = plan(integrity.match_marks(reviews(spark, SMALL), products(spark, SMALL), "asin"))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text
    # The only exchange of rows makes the product keys unique.
    assert text.count("Exchange hashpartitioning") == 1


def test_flag_stops_each_task_before_anything_moves(spark):
    text = plan(integrity.dangling_flag(reviews(spark, SMALL), products(spark, SMALL), "asin"))
    local_limit = text.index("LocalLimit 1")
    assert "Exchange SinglePartition" in text[:local_limit]
    assert "LeftAnti" in text[local_limit:]


def test_key_differences_are_one_aggregate(spark):
    found = integrity.dangling_keys(reviews(spark, SMALL), products(spark, SMALL), "asin", broadcast_bytes=0)
    text = plan(found)
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning(asin") == 1
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(asin")


def test_correlation_moves_sums_only(spark):
    text = plan(features.rating_price_correlation(reviews(spark, SMALL), products(spark, SMALL)))
    parts = text.split("Exchange hashpartitioning(asin")[1:]
    assert parts
    for part in parts:
        assert part.index("partial_") < part.index("FileScan")


def test_plain_join_without_frequent_keys(spark):
    left, right = reviews(spark, SMALL), products(spark, SMALL).select("asin", "price")
    assert "_split" not in plan(split_join(left, right, "asin"))
    assert "_split" in plan(split_join(left, right, "asin", rows_per_split=10))


def test_statistics_take_one_pass(spark):
    nested = nested_products(spark, SMALL)
    assert plan(tasks.task_2(nested)).count("FileScan") == 1
    assert plan(profile.correlation_matrix(table(spark, SMALL, "lineitem"), ["l_tax", "l_discount"])).count("FileScan") == 1
    assert plan(tasks.task_4(products(spark, SMALL))).count("FileScan") == 1


def test_top_k_is_cut_in_every_task(spark):
    df = spark.range(0, 1_000).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    text = executed(vectors.nearest(df, "id", "v", {"q": [1.0, 2.0]}, 5))
    exchange = text.index("Exchange hashpartitioning(query")
    assert re.search(r"WindowGroupLimit .*Partial", text[exchange:])
