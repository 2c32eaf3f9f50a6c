"""The profiling report on raw reviews and products, questions 1 to 7.

``categories`` and ``related`` are text here, as in the CSV files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.columns import first_of_first
from storelens.functions.nested import read_nested, read_nested_list, read_related, related_ids
from storelens.operators.features import rating_price_correlation
from storelens.operators.integrity import early_dangling_flag, dangling_keys, listed_keys
from storelens.operators.profile import column_statistics, counts_map, null_percents, value_counts, weighted_statistics
from storelens.plans.facts import items_of, null_percents_of, numbers_of, written_items, written_rows

DIGITS = 2


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Floating columns rounded half to even."""
    return df.select(
        *[
            F.bround(F.col(f"`{name}`"), digits).alias(name) if kind in ("double", "float") else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def super_categories(products: DataFrame) -> DataFrame:
    """Non-null top category of every product that has a readable one."""
    lists = read_nested_list(products.select("categories"), "categories")
    return lists.select(first_of_first(F.col("categories")).alias("supercat")).where(F.col("supercat").isNotNull())


def related_references(products: DataFrame, key: str = "asin") -> DataFrame:
    """One row per id in any of a product's related lists."""
    typed = read_related(products.select("related"), "related")
    return listed_keys(typed, related_ids(F.col("related")), key)


def question_1(reviews: DataFrame) -> DataFrame:
    return rounded(null_percents(reviews))


def question_2(products: DataFrame) -> DataFrame:
    return rounded(null_percents(products))


def question_3(reviews: DataFrame, products: DataFrame) -> DataFrame:
    return rounded(rating_price_correlation(reviews, products))


def question_4(products: DataFrame, *, approximate: bool = False) -> DataFrame:
    return rounded(column_statistics(products, "price", approximate=approximate))


def question_5(products: DataFrame) -> DataFrame:
    return value_counts(super_categories(products), "supercat")


def question_6(reviews: DataFrame, products: DataFrame, key: str = "asin") -> DataFrame:
    return early_dangling_flag(reviews, products, key)


def question_7(products: DataFrame, key: str = "asin") -> DataFrame:
    return early_dangling_flag(related_references(products, key), products, key)


def dangling_related(products: DataFrame, key: str = "asin") -> DataFrame:
    """Related ids missing from the catalogue, with their number of mentions."""
    return dangling_keys(related_references(products, key), products, key)


def answers(reviews: DataFrame, products: DataFrame, key: str = "asin") -> dict[str, DataFrame]:
    """All seven answers as frames, from one scan of the reviews and two of the products (runs these and a few jobs on the counts).

    The fifth has a row per category, the others one row.
    """
    nested = read_nested(products.select("categories", "related"), lists=["categories"], related=["related"])
    rated = written_rows(reviews, key, "overall", reviews.columns)
    sold = written_rows(products, key, "price", products.columns)
    listed = written_items(nested, {"category": F.array(first_of_first(F.col("categories"))), "mention": related_ids(F.col("related"))})
    ratings, prices = numbers_of(rated, key, "overall"), numbers_of(sold, key, "price")
    return {
        "q1": rounded(null_percents_of(rated, reviews.columns)),
        "q2": rounded(null_percents_of(sold, products.columns)),
        "q3": rounded(rating_price_correlation(ratings, prices, key, weight="n")),
        "q4": rounded(weighted_statistics(prices, "price", "n")),
        "q5": items_of(listed, "category", "supercat"),
        "q6": early_dangling_flag(ratings, prices, key),
        "q7": early_dangling_flag(items_of(listed, "mention", key), prices, key),
    }


def report(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """All seven answers as one row with columns ``q1`` to ``q7``.

    Structs of named numbers, a map for the counts, plain values for the rest, put side by side as scalar
    subqueries of one plan on the counted facts.
    """
    found = answers(reviews, products)
    packed = {name: _packed(found[name]) for name in ("q1", "q2", "q4")}
    packed["q5"] = counts_map(found["q5"], "supercat")
    one_row = reviews.sparkSession.range(0, 1, numPartitions=1)
    return one_row.select(*[packed.get(name, answer).scalar().alias(name) for name, answer in found.items()])


def report_rows(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """The seven answers as rows of question, name and value, category counts of any number included."""
    found = answers(reviews, products)
    rows = found.pop("q5").select(F.lit("q5").alias("question"), F.col("supercat").alias("name"), F.col("n").cast("double").alias("value"))
    for question, answer in found.items():
        values = answer.select(*[F.col(f"`{name}`").cast("double").alias(name) for name in answer.columns])
        long = values.unpivot([], [F.col(f"`{name}`") for name in values.columns], "name", "value")
        rows = rows.unionByName(long.withColumn("question", F.lit(question)))
    return rows


def _packed(one_row: DataFrame) -> DataFrame:
    return one_row.select(F.struct(*[F.col(f"`{name}`") for name in one_row.columns]).alias("packed"))
