"""The profiling report from CSV files to one JSON object."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
import pytest

from pyspark.sql import functions as F

from storelens.functions.text import tokens
from storelens.operators.vectors import vocabulary
from storelens.plans import questions, runs
from storelens.plans.registry import tree_lines
from storelens.sources import csv_tables, sinks
from storelens.sources.shop_views import nested_products, reviews, table
from tests.conftest import SMALL


@pytest.fixture()
def shop(spark, tmp_path):
    reviews = pd.DataFrame(
        {
            "reviewerID": ["u1", "u2", None, "u4", "u5", "u6"],
            "asin": ["001", "002", "001", "009", None, "003"],
            "overall": [5, 3, 4, 1, 2, None],
        }
    )
    products = pd.DataFrame(
        {
            "asin": ["001", "002", "003"],
            "title": ["A", None, "C"],
            "price": [10.0, 4.0, None],
            "categories": ["[['Books', \"Children's\"]]", "[['Books']]", "[['']]"],
            "related": ["{'also_viewed': ['002', '003']}", "{'also_bought': [u'001'], 'other': ['9']}", None],
        }
    )
    reviews.to_csv(tmp_path / "reviews.csv", index=False)
    products.to_csv(tmp_path / "products.csv", index=False)
    return (
        csv_tables.read_csv(spark, str(tmp_path / "reviews.csv"), csv_tables.REVIEW_SCHEMA),
        csv_tables.read_csv(spark, str(tmp_path / "products.csv"), csv_tables.PRODUCT_SCHEMA),
    )


def test_report(shop, tmp_path):
    reviews, products = shop
    sinks.write_report(questions.report(reviews, products), str(tmp_path / "out"), runtime=0.25)
    (part,) = Path(tmp_path / "out").glob("part-*")
    joined = pd.Series([5, 3, 4]).corr(pd.Series([10, 4, 10]))
    assert json.loads(part.read_text()) == {
        "q1": {"reviewerID": 16.67, "asin": 16.67, "overall": 16.67},
        "q2": {"asin": 0.0, "title": 33.33, "price": 33.33, "categories": 0.0, "related": 33.33},
        "q3": round(joined, 2),
        "q4": {"mean": 7.0, "std": 4.24, "min": 4.0, "max": 10.0, "median": 7.0},
        "q5": {"Books": 2},
        "q6": 1,
        "q7": 0,
        "runtime": 0.25,
    }


@pytest.mark.parametrize("work_dir", [None, "work"])
def test_csv_files_to_json(spark, shop, tmp_path, work_dir):
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    runs.profile_csv_files(
        spark, str(tmp_path / "reviews.csv"), str(tmp_path / "products.csv"), str(tmp_path / "answers"),
        work_dir=work_dir and str(tmp_path / work_dir),
    )
    (part,) = Path(tmp_path / "answers").glob("part-*")
    answers = json.loads(part.read_text())
    assert list(answers) == ["q1", "q2", "q3", "q4", "q5", "q6", "q7", "runtime"]
    assert answers["q5"] == {"Books": 2}
    assert answers["runtime"] > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_all_tasks_are_stored(spark, tmp_path):
    out = str(tmp_path / "metrics")
    runs.feature_tasks(reviews(spark, SMALL), nested_products(spark, SMALL).withColumn("title", F.lit("t")), out)
    processed = table(spark, SMALL, "documents").select(F.col("text").alias("title"), F.col("source").alias("category"))
    words = [row["word"] for row in vocabulary(processed.select(tokens(F.col("title")).alias("w")), "w").limit(3).collect()]
    runs.vector_tasks(processed, words, out, k=2)
    train, test = tree_lines(spark, SMALL)
    runs.model_tasks(train, test, out, ["l_orderkey", "l_linenumber"])
    assert sorted(path.name for path in Path(out).glob("task=*")) == [f"task=task_{i}" for i in range(1, 9)]
    assert sinks.load_metrics(spark, out, "task_5").first()["count_total"] == processed.count()
    assert sinks.load_metrics(spark, out, "task_8").first()["test_rmse"] > 0


def test_four_product_columns_are_enough(spark, shop, tmp_path):
    pd.DataFrame({"asin": ["001"], "price": [1.0], "categories": ["[['A']]"], "related": [None]}).to_csv(tmp_path / "few.csv", index=False)
    runs.profile_csv_files(spark, str(tmp_path / "reviews.csv"), str(tmp_path / "few.csv"), str(tmp_path / "few"))
    (part,) = Path(tmp_path / "few").glob("part-*")
    assert set(json.loads(part.read_text())["q2"]) == {"asin", "price", "categories", "related"}


def test_report_rows_hold_every_category(shop):
    reviews, products = shop
    many = products.withColumn("categories", F.concat(F.lit("[['c"), F.col("asin"), F.lit("']]")))
    rows = {(r["question"], r["name"]): r["value"] for r in questions.report_rows(reviews, many).collect()}
    assert {name for question, name in rows if question == "q5"} == {"c001", "c002", "c003"}
    assert rows["q4", "mean"] == 7.0 and rows["q6", "dangling"] == 1.0


def test_dangling_related(shop):
    _, products = shop
    without_last = products.where("asin <> '003'")
    assert [tuple(row) for row in questions.dangling_related(without_last).collect()] == [("003", 1)]
    assert questions.question_7(without_last).first()["dangling"] == 1


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125, 0.375, 1)], "a double, b double, n int")
    assert tuple(questions.rounded(df).first()) == (0.12, 0.38, 1)
