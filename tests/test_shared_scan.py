"""The report from one scan of each table, and nested text without Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from storelens.functions.nested import read_nested
from storelens.operators import features
from storelens.operators.profile import null_percents
from storelens.plans import facts, questions, tasks
from storelens.sources.shop_views import nested_products, product_texts, products, reviews
from tests.conftest import SMALL
from tests.test_plans import plan


def test_each_table_is_scanned_at_most_twice(spark, monkeypatch):
    scans = []
    for name in ("counted_rows", "counted_items"):

        def watched(rows, *rest, make=getattr(facts, name)):
            counted = make(rows, *rest)
            scans.append((rows.columns[0], plan(counted).count("FileScan parquet")))
            return counted

        monkeypatch.setattr(facts, name, watched)
    report = questions.report_rows(reviews(spark, SMALL), product_texts(spark, SMALL).select("asin", "price", "categories", "related"))
    # The products once for their rows and once for their lists; nothing of the tables is left in the answers.
    assert scans == [("asin", 1), ("asin", 1), ("categories", 1)]
    text = plan(report)
    assert "lineitem" not in text and "part.parquet" not in text and "/facts-" in text


def test_report_equals_the_single_questions(spark):
    rated, sold = reviews(spark, SMALL), product_texts(spark, SMALL).select("asin", "price", "categories", "related")
    report = questions.report(rated, sold).first()
    assert report["q1"] == questions.question_1(rated).first()
    assert report["q2"] == questions.question_2(sold).first()
    assert report["q3"] == questions.question_3(rated, sold).first()[0]
    assert report["q4"] == questions.question_4(sold).first()
    assert report["q5"] == {row["supercat"]: row["n"] for row in questions.question_5(sold).collect()}
    assert (report["q6"], report["q7"]) == (questions.question_6(rated, sold).first()[0], questions.question_7(sold).first()[0])


def test_facts_of_odd_rows(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, ["x", None, "x"]), ("a", 1.0, None), (None, None, []), ("b", None, ["y"])], "k string, v double, items array<string>"
    )
    counted = facts.counted_rows(rows, "k", "v", rows.columns)
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([("a", 1.0, 2, 0, 0, 1), (None, None, 1, 1, 1, 0), ("b", None, 1, 0, 1, 0)], key=str)
    items = facts.counted_items(rows, {"item": F.col("items"), "again": F.col("items")})
    assert sorted(map(tuple, items.collect())) == [("again", "x", 2), ("again", "y", 1), ("item", "x", 2), ("item", "y", 1)]
    assert facts.null_percents_of(counted, rows.columns).first() == null_percents(rows).first()
    empty = facts.counted_rows(rows.limit(0), "k", "v", rows.columns)
    assert facts.null_percents_of(empty, rows.columns).first().asDict() == {"k": None, "v": None, "items": None}


@pytest.mark.parametrize("base", [0.0, 1e8])
def test_weighted_correlation(spark, base):
    rated = spark.createDataFrame([(f"k{i % 7}", base + (i * i) % 5) for i in range(80)], "asin string, overall double")
    sold = spark.createDataFrame([(f"k{i % 9}", base + i % 4) for i in range(20)], "asin string, price double")
    counted = [df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")) for df in (rated, sold)]
    plain = features.rating_price_correlation(rated, sold).first()["corr"]
    assert features.rating_price_correlation(*counted, weight="n").first()["corr"] == pytest.approx(plain)


def test_python_only_where_text_needs_it(spark):
    texts = product_texts(spark, SMALL).select("asin", "categories", "related")
    text = plan(read_nested(texts, lists=["categories"], related=["related"]))
    assert "ArrowEvalPython" not in text and "Union" not in text
    odd = texts.unionByName(texts.limit(3).withColumn("categories", F.lit("[('a',)]")).withColumn("related", F.lit("{'also_viewed': (1, 2.5)}")))
    read = read_nested(odd, lists=["categories"], related=["related"])
    # Every scan of the first branch comes before the Python node of the second.
    text = plan(read)
    assert text.count("ArrowEvalPython") >= 1
    assert "FileScan" in text[: text.index("ArrowEvalPython")] and "from_json" in text[: text.index("ArrowEvalPython")]
    # A tuple is no list, in either place, and a literal all the same.
    assert read.where("get(categories, 0) is null and size(categories) = 1 and related.also_viewed is null and not categories_bad and not related_bad").count() == 3
    assert read.count() == texts.count() + 3


def test_distinct_counts_do_not_expand_rows(spark):
    text = plan(tasks.task_2(nested_products(spark, SMALL)))
    assert "Expand" not in text and text.count("FileScan") == 1


def test_products_with_clashing_names_stay(spark):
    df = spark.createDataFrame([("[[u'x']]", "own", 1)], "categories string, _value string, text int")
    (row,) = read_nested(df, lists=["categories"]).collect()
    assert row.asDict() == {"categories": [["x"]], "_value": "own", "text": 1, "categories_bad": False}
    assert products(spark, SMALL).count() == 200
