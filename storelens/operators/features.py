"""Product features: ratings, sales rank, related products, imputed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.functions import columns as C
from storelens.operators.joins import lookup_join
from storelens.operators.quantiles import approximate_quantiles, exact_quantiles


def rated_prices(reviews: DataFrame, products: DataFrame, key: str = "asin") -> DataFrame:
    """Every review with the price of its product, where both numbers are present."""
    rated = reviews.select(key, "overall").dropna()
    priced = products.select(key, "price").dropna()
    return lookup_join(rated, priced, key)


def rating_price_correlation(
    reviews: DataFrame, products: DataFrame, key: str = "asin", *, rating: str = "overall", price: str = "price", weight: str | None = None
) -> DataFrame:
    """Pearson correlation of rating and price over all joined pairs, as one row.

    With ``weight`` a row of either table stands for as many rows as that column says.

    The pairs are not built.  Within one key every rating meets every price, so
    a key adds what its count, mean and squared distances to its mean say.  The
    keys' means are then compared with the means of all pairs: only distances are squared,
    so nothing cancels for values that are large next to their spread.
    """
    ratings = _moments(reviews, key, rating, "x", weight)
    prices = _moments(products, key, price, "y", weight)
    # Both sides are grouped by the key: the join moves nothing.
    pairs = ratings.join(prices, key)
    weight = F.col("x_n") * F.col("y_n")
    means = pairs.agg(
        (F.sum(weight * F.col("x_mean")) / F.sum(weight)).alias("x_all"), (F.sum(weight * F.col("y_mean")) / F.sum(weight)).alias("y_all")
    )
    x, y = F.col("x_mean") - means.select("x_all").scalar(), F.col("y_mean") - means.select("y_all").scalar()
    spread_x = F.sum(weight * x * x) + F.sum(F.col("y_n") * F.col("x_squares"))
    spread_y = F.sum(weight * y * y) + F.sum(F.col("x_n") * F.col("y_squares"))
    varied = (F.max("x_max") > F.min("x_min")) & (F.max("y_max") > F.min("y_min"))
    corr = F.try_divide(F.sum(weight * x * y), F.sqrt(spread_x) * F.sqrt(spread_y))
    return pairs.agg(F.when(varied, corr).alias("corr"))


def _moments(df: DataFrame, key: str, column: str, name: str, weight: str | None = None) -> DataFrame:
    """Count, mean, squared distances to the mean, least and largest value per key, nulls left out."""
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull() & F.col(key).isNotNull())
    if weight is not None:
        # The key's mean first, so that only distances are squared; a key has few different values.
        times, own = F.col(weight), Window.partitionBy(key)
        mean = F.sum(times * value).over(own) / F.sum(times).over(own)
        return present.withColumn("_mean", mean).groupBy(key).agg(
            F.sum(times).cast("double").alias(f"{name}_n"),
            F.max("_mean").alias(f"{name}_mean"),
            F.sum(times * (value - F.col("_mean")) * (value - F.col("_mean"))).alias(f"{name}_squares"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
        )
    return present.groupBy(key).agg(
        F.count(value).cast("double").alias(f"{name}_n"),
        F.avg(value).alias(f"{name}_mean"),
        (F.var_pop(value) * F.count(value)).alias(f"{name}_squares"),
        F.min(value).alias(f"{name}_min"),
        F.max(value).alias(f"{name}_max"),
    )


def rating_features(products: DataFrame, reviews: DataFrame, key: str = "asin") -> DataFrame:
    """Every product with the mean and the count of its ratings.

    Reviews are aggregated before the join.  A product without any review has
    null for both; one with only unrated reviews has a null mean and count 0.
    """
    ratings = reviews.groupBy(key).agg(
        F.avg("overall").alias("meanRating"), F.count("overall").alias("countRating")
    )
    # The products' keys do not repeat much, so none is looked for that would need splitting.
    return products.select(key).join(ratings, key, "left")


def category_features(products: DataFrame) -> DataFrame:
    """Category, and the first stored sales rank with its category.

    ``categories`` is a list of lists and ``salesRank`` a map.  A row-wise step.
    """
    return products.withColumns(
        {
            "category": C.first_of_first(F.col("categories")),
            "bestSalesCategory": C.first_key(F.col("salesRank")),
            "bestSalesRank": C.first_value(F.col("salesRank")),
        }
    )


def related_prices(products: DataFrame, attribute: str = "also_viewed", key: str = "asin") -> DataFrame:
    """One row per listed related product with its price; products without a list keep one row."""
    item = f"{attribute}_{key}"
    listed = products.select(key, F.explode_outer(F.col(f"related.{attribute}")).alias(item))
    prices = products.select(F.col(key).alias(item), "price").where(F.col(item).isNotNull())
    return lookup_join(listed, prices, item, "left").select(key, item, "price")


def related_features(
    products: DataFrame, attribute: str = "also_viewed", key: str = "asin"
) -> DataFrame:
    """Every product with the mean price and the number of its also-viewed products.

    The mean covers the listed products that have a price; the number counts all
    listed ids, also those missing from the catalogue.  Both are null for a
    product without a list.  The price side is reduced to one row per product
    key first and the sums are carried through the join, so repeated keys on
    either side weigh as much as in a plain join without being multiplied out.
    """
    listed = products.select(
        F.col(key).alias("_product"), F.explode(F.col(f"related.{attribute}")).alias(key)
    ).where(F.col(key).isNotNull())
    prices = products.select(key, "price").where(F.col(key).isNotNull())
    per_key = prices.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("price").alias("_priced"), F.sum("price").alias("_sum")
    )
    per_product = (
        lookup_join(listed, per_key, key, "left", measure=prices)
        .groupBy(F.col("_product").alias(key))
        .agg(
            F.try_divide(F.sum("_sum"), F.sum("_priced")).alias("meanPriceAlsoViewed"),
            F.sum(F.coalesce("_rows", F.lit(1))).alias("_listed"),
        )
    )
    # Whether there is a list is settled before the join, so that a caller who does
    # not ask for the lists does not move them.
    has_list = C.has_items(F.col(f"related.{attribute}"))
    # One row per product on either side: no key needs splitting.
    return (
        products.select(key, "related", has_list.alias("_has_list")).join(per_product, key, "left")
        .withColumns(
            {
                "meanPriceAlsoViewed": F.when(F.col("_has_list"), F.col("meanPriceAlsoViewed")),
                # A list of nulls only has no joined rows, yet it is a list.
                "countAlsoViewed": F.when(
                    F.col("_has_list") & F.col(key).isNotNull(), F.coalesce("_listed", F.lit(0).cast("long"))
                ),
            }
        )
        .drop("_listed", "_has_list")
    )


def imputed_features(
    products: DataFrame, *, approximate_error: float | None = None, unknown: str = "unknown"
) -> DataFrame:
    """Price as single precision with nulls filled by mean or median, title by a label.

    Mean and median are measured first.  The median is exact; with
    ``approximate_error`` its rank may be off by that share of the rows.
    """
    priced = products.withColumn("price", C.to_float(F.col("price")))
    if approximate_error is None:
        (median,) = exact_quantiles(priced, "price", [0.5])
    else:
        (median,) = approximate_quantiles(priced, "price", [0.5], approximate_error)
    mean = priced.agg(F.avg("price").alias("mean")).first()["mean"]
    return priced.withColumns(
        {
            "meanImputedPrice": C.fill_null(F.col("price"), mean),
            "medianImputedPrice": C.fill_null(F.col("price"), median),
            "unknownImputedTitle": C.label_if_blank(F.col("title"), unknown),
        }
    )
