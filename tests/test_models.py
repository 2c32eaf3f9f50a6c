from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from storelens.functions.text import tokens
from storelens.operators import encode, trees, vectors
from storelens.plans import tasks
from storelens.sources.shop_views import table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def categories(spark):
    rows = [("b",)] * 5 + [("a",)] * 3 + [("c",)] * 3 + [("d",)]
    return spark.createDataFrame(rows, "category string").repartition(3)


def test_index_by_frequency_then_name(categories):
    indexed = encode.index_categories(categories, "category", "i").distinct().collect()
    assert {row["category"]: row["i"] for row in indexed} == {"b": 0.0, "a": 1.0, "c": 2.0, "d": 3.0}


@pytest.mark.parametrize("invalid, rows", [("skip", 12), ("keep", 13)])
def test_null_category(spark, categories, invalid, rows):
    with_null = categories.unionByName(spark.createDataFrame([(None,)], "category string"))
    assert encode.index_categories(with_null, "category", "i", invalid=invalid).count() == rows
    assert tasks.task_6(with_null, k=2, invalid=invalid).first()["count_total"] == rows
    with pytest.raises(Exception, match="(?i)null"):
        encode.index_categories(with_null, "category", "i").collect()


def test_one_hot_and_components(categories):
    encoding = encode.fit_category_encoding(categories, k=3)
    assert encoding.labels == ["b", "a", "c", "d"]
    loadings = encoding.model.stages[2].pc.toArray()
    assert np.allclose(loadings.T @ loadings, np.eye(3), atol=1e-12)

    row = tasks.task_6(categories, k=3).first()
    assert row["meanVector_categoryOneHot"] == pytest.approx([5 / 12, 3 / 12, 3 / 12, 1 / 12])
    rows = np.array([r["categoryPCA"].toArray() for r in encoding.transform(categories).collect()])
    assert np.allclose(np.abs(row["meanVector_categoryPCA"]), np.abs(rows.mean(axis=0)), atol=1e-12)
    assert row["count_total"] == 12


@pytest.fixture(scope="module")
def planted(spark):
    """The label has 16 times 8 levels, so depth 7 is enough and 5 is too little."""
    level = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(128))
    noise = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1000)) / 1000 - 0.5
    df = spark.range(0, 12_000, numPartitions=4).select(
        "id",
        F.floor(level / 8).cast("double").alias("x"),
        F.pmod(level, F.lit(8)).cast("double").alias("y"),
        (level * 10 + noise).alias("overall"),
    )
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)


def test_split_by_key(planted):
    left, right = trees.split_by_key(planted, "id")
    assert left.count() + right.count() == 12_000
    assert left.join(right, "id").count() == 0
    assert 0.72 < left.count() / 12_000 < 0.78
    again, _ = trees.split_by_key(planted.repartition(7, "x"), "id")
    assert again.join(left, "id", "left_anti").count() == 0
    inner, outer = trees.split_by_key(left, "id", seed=1)
    assert inner.count() > 6_000 and outer.count() > 1_500


@pytest.mark.parametrize("parallelism", [1, 3])
def test_tuning_finds_the_planted_depth(planted, parallelism):
    train, test = trees.split_by_key(planted, "id")
    tuned = trees.tune_depth(train, "id", depths=(2, 5, 7), parallelism=parallelism)
    assert tuned.depth == 7
    assert tuned.valid_rmse[2] > tuned.valid_rmse[5] > tuned.valid_rmse[7]
    assert tuned.valid_rmse[7] == pytest.approx(1 / math.sqrt(12), rel=0.2)
    scored = tuned.model.transform(test)
    evaluator = RegressionEvaluator(labelCol="overall", predictionCol="depth_7", metricName="rmse")
    assert trees.rmse(scored, prediction="depth_7").first()["rmse"] == pytest.approx(evaluator.evaluate(scored))
    assert scored.select("depth_7").distinct().count() <= 2**7


def test_tasks_7_and_8(planted):
    train, test = trees.split_by_key(planted, "id")
    plain = tasks.task_7(train, test).first()
    tuned = tasks.task_8(train, test, ["id"]).first()
    assert list(tuned.asDict()) == [
        "test_rmse", "valid_rmse_depth_5", "valid_rmse_depth_7", "valid_rmse_depth_9", "valid_rmse_depth_12",
    ]
    assert tuned["test_rmse"] < plain["test_rmse"]
    assert tuned == tasks.task_8(train, test, ["id"]).first()


def test_tuning_without_key_columns_splits_by_content(planted):
    train, _ = trees.split_by_key(planted, "id")
    assert trees.tune_depth(train.drop("id", "x", "y"), depths=(2, 3)).depth == 3


def test_empty_validation_part(planted):
    with pytest.raises(ValueError, match="validation"):
        trees.tune_depth(planted.withColumn("k", F.lit(1)), "k", depths=(2,))


def test_best_candidate_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(9, 0.5), (5, 0.5), (7, 0.7), (3, None)], "depth int, rmse double")
    assert trees.best_candidate(df, "rmse", "depth").first()["depth"] == 5


@pytest.fixture(scope="module")
def words(spark):
    kept = table(spark, SMALL, "documents").select(tokens(F.col("text")).alias("words")).persist()
    yield kept
    kept.unpersist()


def test_vocabulary_of_the_model(words):
    model = vectors.fit_word_vectors(words, "words")
    learned = {row["word"] for row in model.getVectors().collect()}
    assert learned == {row["word"] for row in vectors.vocabulary(words, "words").collect()}
    asked = sorted(learned)[:2]
    found = vectors.synonyms(model, asked, 5)
    assert found.groupBy("query").count().collect() == [(asked[0], 5), (asked[1], 5)] or found.count() == 10
    assert found.where("query = word").count() == 0
    assert found.where("abs(similarity) > 1.000001").count() == 0


def test_large_corpora_train_in_more_tasks(words):
    """No task trains on more words than asked for; small corpora keep the fixed number of tasks."""
    trained = vectors.vocabulary(words, "words").agg(F.sum("n").alias("n")).first()["n"]
    model = vectors.fit_word_vectors(words, "words", words_per_task=2_000)
    assert model.getNumPartitions() == -(-trained // 2_000) > vectors.PARTITIONS
    assert model.getVectors().count() == vectors.vocabulary(words, "words").count()
    assert vectors.fit_word_vectors(words, "words").getNumPartitions() == vectors.PARTITIONS


def test_task_5(spark, words):
    asked = [row["word"] for row in vectors.vocabulary(words, "words").orderBy(F.desc("n"), "word").limit(3).collect()]
    titles = table(spark, SMALL, "documents").withColumnRenamed("text", "title")
    row = tasks.task_5(titles, asked).first()
    assert row["count_total"] == titles.count()
    assert row["size_vocabulary"] == vectors.vocabulary(words, "words").count()
    for i in range(3):
        similar = [pair["similarity"] for pair in row[f"word_{i}_synonyms"]]
        assert len(similar) == 10
        assert similar == sorted(similar, reverse=True)


@pytest.mark.parametrize("ranked_in_tasks", [1_000, 5])
def test_nearest_over_many_partitions(spark, monkeypatch, ranked_in_tasks):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(500, 8))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "i int, v array<double>").repartition(6)
    queries = {"a": data[0].tolist(), "b": rng.normal(size=8).tolist()}
    monkeypatch.setattr(vectors, "RANKED_IN_TASKS", ranked_in_tasks)
    found = vectors.nearest(df, "i", "v", queries, 7).collect()
    for name, vector in queries.items():
        cosine = data @ np.array(vector) / np.linalg.norm(data, axis=1) / np.linalg.norm(vector)
        expected = np.argsort(-cosine)[:7].tolist()
        assert [row["i"] for row in sorted(found, key=lambda r: r["rank"]) if row["query"] == name] == expected


def test_zero_vector_has_no_similarity(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "i int, v array<double>")
    assert [row["i"] for row in vectors.nearest(df, "i", "v", {"q": [2.0, 0.0]}).collect()] == [2]
