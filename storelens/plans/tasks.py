"""The feature and model tasks 1 to 8, each reduced to one row of metrics.

The metric names are fixed values: users compare results by them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions.stats import null_count
from storelens.functions.text import tokens
from storelens.operators import encode, features, trees, vectors
from storelens.operators.category_pca import category_means


def _mean_variance_nulls(column: str) -> list:
    return [
        F.avg(column).alias(f"mean_{column}"),
        F.var_samp(column).alias(f"variance_{column}"),
        null_count(F.col(column)).alias(f"numNulls_{column}"),
    ]


def task_1(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Ratings per product."""
    return features.rating_features(products, reviews).agg(
        F.count(F.lit(1)).alias("count_total"),
        *_mean_variance_nulls("meanRating"),
        *_mean_variance_nulls("countRating"),
    )


def task_2(products: DataFrame) -> DataFrame:
    """Category and best sales rank."""
    rank = F.col("bestSalesRank").cast("double")
    # Counted once per pair of categories, which are few; two distinct counts over the rows would expand each row.
    pairs = features.category_features(products).groupBy("category", "bestSalesCategory").agg(
        F.count(F.lit(1)).alias("rows"), F.count(rank).alias("n"), F.avg(rank).alias("mean"), (F.var_pop(rank) * F.count(rank)).alias("squares")
    )

    def first_of(column: str, other: str) -> Column:
        """True in one pair for every category."""
        place = F.row_number().over(Window.partitionBy(column).orderBy(other))
        return F.col(column).isNotNull() & (place == 1)

    def nulls(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(column).isNull(), rows)), F.lit(0).cast("long"))

    n, rows, mean = F.col("n"), F.col("rows"), F.col("mean")
    marked = pairs.withColumns(
        {"new_category": first_of("category", "bestSalesCategory"), "new_best": first_of("bestSalesCategory", "category")}
    )
    # Squares within the pairs, and those of the pairs' means.
    squares = F.sum("squares") + F.sum(n * mean * mean) - F.sum(n * mean) * F.try_divide(F.sum(n * mean), F.sum(n))
    return marked.agg(
        F.coalesce(F.sum(rows), F.lit(0).cast("long")).alias("count_total"),
        F.try_divide(F.sum(n * mean), F.sum(n)).alias("mean_bestSalesRank"),
        (squares / F.nullif(F.sum(n) - 1, F.lit(0))).alias("variance_bestSalesRank"),
        nulls("category").alias("numNulls_category"),
        F.count_if("new_category").alias("countDistinct_category"),
        nulls("bestSalesCategory").alias("numNulls_bestSalesCategory"),
        F.count_if("new_best").alias("countDistinct_bestSalesCategory"),
    )


def task_3(products: DataFrame) -> DataFrame:
    """Price and number of also-viewed products."""
    return features.related_features(products).agg(
        F.count(F.lit(1)).alias("count_total"),
        *_mean_variance_nulls("meanPriceAlsoViewed"),
        *_mean_variance_nulls("countAlsoViewed"),
    )


def task_4(products: DataFrame, *, approximate_error: float | None = None) -> DataFrame:
    """Imputed prices and titles."""
    return features.imputed_features(products, approximate_error=approximate_error).agg(
        F.count(F.lit(1)).alias("count_total"),
        *_mean_variance_nulls("meanImputedPrice"),
        *_mean_variance_nulls("medianImputedPrice"),
        F.count_if(F.col("unknownImputedTitle") == "unknown").alias("numUnknowns_unknownImputedTitle"),
    )


def task_5(
    products: DataFrame, words: Sequence[str], *, k: int = 10, seed: int = 42, partitions: int = vectors.PARTITIONS
) -> DataFrame:
    """Word vectors of the titles: vocabulary size and the synonyms of given words."""
    titles = products.select(tokens(F.col("title")).alias("titleArray"))
    model = vectors.fit_word_vectors(titles, "titleArray", seed=seed, partitions=partitions)
    found = vectors.synonyms(model, words, k).groupBy().agg(
        *[
            # At most k entries per word.
            F.transform(
                F.sort_array(
                    F.collect_list(
                        F.when(F.col("query") == word, F.struct((-F.col("similarity")).alias("order"), "word", "similarity"))
                    )
                ),
                lambda entry: F.struct(entry["word"].alias("word"), entry["similarity"].alias("similarity")),
            ).alias(f"word_{i}_synonyms")
            for i, word in enumerate(words)
        ]
    )
    return found.select(
        titles.agg(F.count(F.lit(1))).scalar().alias("count_total"),
        model.getVectors().agg(F.count(F.lit(1))).scalar().alias("size_vocabulary"),
        *found.columns,
    )


def task_6(products: DataFrame, *, k: int = encode.COMPONENTS, invalid: str = "error") -> DataFrame:
    """Mean one-hot vector and mean principal components of the category."""
    return category_means(products, "category", k=k, invalid=invalid)


def task_7(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test error of a tree of the plain depth."""
    return trees.tree_rmse(train, test)


def task_8(
    train: DataFrame, test: DataFrame, split_keys: Sequence[str] = (), *, parallelism: int = 1
) -> DataFrame:
    """Test error of the tuned tree and the validation error of every depth."""
    tuned = trees.tune_depth(train, *split_keys, parallelism=parallelism)
    scored = trees.rmse(tuned.model.transform(test), prediction=f"depth_{tuned.depth}", name="test_rmse")
    return scored.select(
        "test_rmse",
        *[F.lit(value).alias(f"valid_rmse_depth_{depth}") for depth, value in tuned.valid_rmse.items()],
    )
