"""Metrics that two engines agreed on beforehand, on the tables of scale 0.01.

Names in the order of the reports; doubles to six digits.
"""

from __future__ import annotations

import pytest

from storelens.plans import questions, tasks
from storelens.sources.shop_views import nested_products, product_texts, products, reviews

SF = "/root/testdata/sf0.01"


def rounded(df):
    return [round(value, 6) if isinstance(value, float) else value for value in df.first()]


def test_task_1(spark):
    assert rounded(tasks.task_1(reviews(spark, SF), products(spark, SF))) == [
        2000, 3.006709, 0.073149, 69, 27.896427, 30.103257, 69,
    ]


def test_task_2(spark):
    assert rounded(tasks.task_2(nested_products(spark, SF))) == [2000, 25.6225, 206.177605, 294, 6, 400, 6]


def test_task_3(spark):
    assert rounded(tasks.task_3(nested_products(spark, SF))) == [
        2000, 949.995985, 772.55598, 792, 1.699925, 0.210188, 667,
    ]


def test_task_4(spark):
    assert rounded(tasks.task_4(products(spark, SF))) == [
        2000, 949.983372, 714.283331, 0, 949.98575, 714.283365, 0, 322,
    ]


def test_task_4_with_approximate_median(spark):
    exact = tasks.task_4(products(spark, SF)).first()
    row = tasks.task_4(products(spark, SF), approximate_error=0.01).first()
    assert row["mean_meanImputedPrice"] == exact["mean_meanImputedPrice"]
    assert row["mean_medianImputedPrice"] == pytest.approx(exact["mean_medianImputedPrice"], abs=0.5)


def test_question_5(spark):
    assert {row["supercat"]: row["n"] for row in questions.question_5(product_texts(spark, SF)).collect()} == {
        "ECONOMY": 270, "LARGE": 287, "MEDIUM": 296, "PROMO": 284, "SMALL": 274, "STANDARD": 295,
    }


def test_question_7(spark):
    texts = product_texts(spark, SF)
    assert questions.related_references(texts).count() == 3199
    assert questions.dangling_related(texts).groupBy().sum("n").first()[0] == 468
