"""Word vectors and nearest neighbours by cosine similarity."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.operators import skip_gram
from storelens.operators.layout import new_path

# Fixed values of the word-vector training.
VECTOR_SIZE = 16
MIN_COUNT = 100
PARTITIONS = 4
# Words that one task trains on at most; a larger corpus is dealt over more tasks.
WORDS_PER_TASK = 2_000_000

# Spark cuts a ranking to its first rows in every task up to this many rows.
RANKED_IN_TASKS = 1_000


def vocabulary(df: DataFrame, words: str, min_count: int = MIN_COUNT) -> DataFrame:
    """Words that occur at least ``min_count`` times, with their counts."""
    return (
        df.select(F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def fit_word_vectors(
    df: DataFrame,
    words: str,
    *,
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    partitions: int = PARTITIONS,
    words_per_task: int = WORDS_PER_TASK,
    seed: int = 42,
    counts: DataFrame | None = None,
) -> Word2VecModel:
    """Train word vectors on token arrays.

    The vectors depend on the number of partitions, which is therefore a parameter.  It is the least number:
    a corpus with more than ``words_per_task`` trained words for each gets more, so that no task's time grows with it.
    ``counts`` is the corpus' ``vocabulary``, for callers that have it already.
    """
    counts = vocabulary(df, words, min_count) if counts is None else counts.where(F.col("n") >= min_count)
    # Every word of the model has to be on the driver, as in Spark's own trainer.
    known = counts.where("word is not null").orderBy(F.desc("n"), "word").select("word", "n").toArrow().combine_chunks()
    number = known["n"].to_numpy()
    if not len(number):
        raise ValueError(f"no word occurs {min_count} times")
    partitions = max(partitions, -(-int(number.sum()) // words_per_task))
    trainer = Word2Vec(
        inputCol=words,
        outputCol="_vector",
        vectorSize=vector_size,
        minCount=min_count,
        numPartitions=partitions,
        seed=seed,
    )
    trained = skip_gram.fit(
        df, words, known["word"].combine_chunks(), number, size=vector_size, partitions=partitions, step=trainer.getStepSize(), seed=seed
    )
    return _model(trainer, trained)


def _model(trainer: Word2Vec, trained: DataFrame) -> Word2VecModel:
    """Spark's model with the given vectors, by way of the files that such a model is saved in."""
    spark = trained.sparkSession
    path = new_path(spark, "word_vectors")
    trained.write.parquet(f"{path}/data")
    described = {
        "class": "org.apache.spark.ml.feature.Word2VecModel",
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "uid": trainer.uid,
        "paramMap": {param.name: value for param, value in trainer._paramMap.items()},
        "defaultParamMap": {param.name: value for param, value in trainer._defaultParamMap.items()},
    }
    spark.createDataFrame([(json.dumps(described),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return Word2VecModel.load(path)


def synonyms(model: Word2VecModel, words: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most similar words for each given word, as rows."""
    found = [
        model.findSynonyms(word, k).select(F.lit(word).alias("query"), "word", "similarity") for word in words
    ]
    return reduce(DataFrame.unionByName, found)


def dot_product(a: Column, b: Column) -> Column:
    """Sum of the products of two numeric arrays of equal length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def nearest(
    df: DataFrame, id_column: str, vector_column: str, queries: Mapping[str, Sequence[float]], k: int = 10
) -> DataFrame:
    """The ``k`` rows most similar by cosine to each query vector, over the whole table.

    The queries travel inside the expression, so the table is read once and each
    task keeps only its own best ``k`` per query before anything is moved.  An
    all-zero vector has no similarity to anything.
    """
    vector = F.col(vector_column)
    scores = F.array(
        *[
            F.struct(
                F.lit(name).alias("query"),
                F.try_divide(dot_product(vector, _unit_array(query)), F.col("_length")).alias("similarity"),
            )
            for name, query in queries.items()
        ]
    )
    scored = (
        df.withColumn("_length", F.sqrt(dot_product(vector, vector)))
        .select(id_column, F.inline(scores))
        .where(F.col("similarity").isNotNull())
    )
    if k >= RANKED_IN_TASKS:
        scored = _best_of_each(scored, list(queries), id_column, k)
    best_first = Window.partitionBy("query").orderBy(F.desc("similarity"), id_column)
    return scored.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)


def _best_of_each(scored: DataFrame, names: Sequence[str], id_column: str, k: int) -> DataFrame:
    """The first ``k`` rows of each query by a sort with a limit, one pass per query."""
    best = [
        scored.where(F.col("query") == name).orderBy(F.desc("similarity"), id_column).limit(k) for name in names
    ]
    return reduce(DataFrame.unionByName, best)


def _unit_array(query: Sequence[float]) -> Column:
    length = math.sqrt(sum(x * x for x in query))
    return F.array(*[F.lit(x / length if length else None).cast("double") for x in query])


def vectors_of(df: DataFrame, id_column: str, vector_column: str, ids: Sequence) -> dict:
    """The vectors of a few given ids, for use as queries (runs one job)."""
    rows = df.where(F.col(id_column).isin(list(ids))).select(id_column, vector_column).collect()
    return {row[id_column]: [float(x) for x in row[vector_column]] for row in rows}
