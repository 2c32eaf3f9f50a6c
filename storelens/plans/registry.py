"""Named queries over the generated tables, one or more per operator.

Each takes the session and a data directory and reads whole tables.  Floating
results are rounded to six digits so that they can be compared across engines;
counts that may be null are given as doubles for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.nested import read_nested_list, read_related, related_ids
from storelens.functions.text import tokens
from storelens.operators import cooccurrence, encode, features, integrity, level_trees, profile, quantiles, sketches, trees, vectors
from storelens.operators.category_pca import category_means, fit_components
from storelens.operators.joins import lookup_join
from storelens.operators.layout import spread, written
from storelens.plans import questions, tasks
from storelens.sources.csv_tables import development_slice, missing_to_null
from storelens.sources.shop_views import nested_products, product_texts, products, reviews, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TREE_FEATURES = ("l_quantity", "l_discount", "l_tax")
SEARCHED_IDS = (0, 1, 2)
TOP_K = 10


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def six_digits(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(name).cast("double"), 6).alias(name) if kind in ("double", "float") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in as many tasks as there are cores, for work on their texts."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


# Profiling


@query
def null_pct_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.null_percents(reviews(spark, sf_dir)))


@query
def null_pct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.null_percents_long(products(spark, sf_dir)))


@query
def null_pct_doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = lookup_join(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "left")
    return six_digits(profile.null_percents(labelled))


@query
def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as text with tokens mixed in; a token with a space around it is not one."""
    text = """
    select l_orderkey, l_partkey,
      case l_orderkey % 23 when 0 then 'NA' when 1 then 'null' when 2 then '' when 3 then ' NA' when 4 then 'na'
        else cast(cast(l_quantity as int) as string) end as overall
    from {lineitem}
    """
    read = missing_to_null(spark.sql(text, lineitem=table(spark, sf_dir, "lineitem")))
    return read.withColumn("rating", F.col("overall").try_cast("double"))


@query
def price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.column_statistics(products(spark, sf_dir), "price"))


@query
def price_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.describe_column(products(spark, sf_dir), "price"))


@query
def price_quantile_disc(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = products(spark, sf_dir)
    found = quantiles.exact_quantiles(source, "price", QUANTILES, discrete=True)
    # The row is built by an aggregate so that it depends on the table like the others.
    return source.agg(
        F.count("price").alias("n"),
        *[F.lit(value).cast("double").alias(f"p{round(p * 100)}") for p, value in zip(QUANTILES, found, strict=True)],
    )


@query
def order_key_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the order keys moved by 2**60, where doubles are 256 apart; the median as text with its places."""
    moved = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey").cast("long") + F.lit(2**60)).alias("k"))
    found = quantiles.exact_quantiles(moved, "k", QUANTILES, discrete=True)
    (median,) = quantiles.exact_quantiles(moved, "k", [0.5])
    return moved.agg(
        F.count("k").alias("n"),
        *[F.lit(value).cast("long").alias(f"p{round(p * 100)}") for p, value in zip(QUANTILES, found, strict=True)],
        F.lit(median).cast("decimal(38,6)").cast("string").alias("median"),
    )


@query
def wide_decimal_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of prices of both signs with 30 places, as text."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    signed = F.when(F.col("l_orderkey") % 2 == 0, price).otherwise(-price) * F.lit("100000000000000000.01").cast("decimal(20,2)")
    wide = table(spark, sf_dir, "lineitem").select(signed.cast("decimal(38,4)").alias("v"))
    found = quantiles.exact_quantiles(wide, "v", QUANTILES, discrete=True)
    return wide.agg(F.count("v").alias("n"), *[F.lit(str(v)).alias(f"p{round(p * 100)}") for p, v in zip(QUANTILES, found, strict=True)])


@query
def approximate_quantile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quantiles of the line prices: whether the counted rank error keeps the bound."""
    found = sketches.audited_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", QUANTILES, 0.01)
    return found.select("probability", "n", (F.col("rank_error") <= 0.01).alias("within"))


@query
def merged_sketch_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the prices by return flag and mode, merged to those of the flags: counted rank errors of the merged ones."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", F.col("l_extendedprice").cast("double").alias("price"))
    parts = written(sketches.quantile_sketches(lines, "price", "l_returnflag", "l_linenumber"), "sketches")
    merged = sketches.sketch_quantiles(sketches.merged_sketches(parts, "l_returnflag"), (0.5,)).select("l_returnflag", F.get("quantiles", F.lit(0)).alias("median"))
    placed = lookup_join(lines, merged, "l_returnflag").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price") < F.col("median")).alias("below"), F.count_if(F.col("price") <= F.col("median")).alias("upto")
    )
    off = F.greatest(F.col("below") - F.col("n") / 2, F.col("n") / 2 - F.col("upto"), F.lit(0))
    return placed.select("l_returnflag", "n", (off <= F.col("n") * 0.03).alias("within"))


@query
def line_price_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.describe_column(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query
def corr_matrix_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(profile.correlation_matrix(table(spark, sf_dir, "lineitem"), NUMERIC))


@query
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


@query
def distinct_part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(table(spark, sf_dir, "part"), "p_type")


@query
def supercategory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.question_5(product_texts(spark, sf_dir))


@query
def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven answers as rows, with every category and its count."""
    return questions.report_rows(
        reviews(spark, sf_dir), product_texts(spark, sf_dir).select("asin", "price", "categories", "related")
    )


@query
def profile_report_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as it is written out, one row, its category counts taken out of their map."""
    report = questions.report(reviews(spark, sf_dir), product_texts(spark, sf_dir).select("asin", "price", "categories", "related"))
    return report.select(
        F.col("q1.overall").alias("null_overall"), F.col("q2.price").alias("null_price"), F.col("q3").alias("corr"), F.col("q4.median").alias("median"),
        F.col("q6").cast("long").alias("dangling"), F.col("q7").cast("long").alias("dangling_related"), F.explode("q5").alias("supercat", "n"),
    )


@query
def inner_join_rated_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.rated_prices(reviews(spark, sf_dir), products(spark, sf_dir))


@query
def rating_price_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(features.rating_price_correlation(reviews(spark, sf_dir), products(spark, sf_dir)))


@query
def shifted_price_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation where two of three products cost nothing and have no reviews, the others 1e7 and some cents."""
    part, lines = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    sold = F.col("p_partkey") % 3 == 0
    priced = part.select(
        F.col("p_partkey").alias("asin"), F.when(sold, F.lit(1.0e7) + (F.col("p_partkey") % 100) / 100).otherwise(0.0).alias("price")
    )
    key = F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey")).otherwise(-1 - F.col("l_partkey"))
    rated = lines.select(key.alias("asin"), (F.col("l_partkey") % 100 + F.col("l_quantity") % 5).alias("overall"))
    return six_digits(features.rating_price_correlation(rated, priced))


@query
def development_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The development slice of the reviews: a tenth of the products with all their reviews."""
    return development_slice(reviews(spark, sf_dir), "asin", 10)


@query
def review_match_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.match_marks(reviews(spark, sf_dir), products(spark, sf_dir), "asin")


@query
def dangling_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.dangling_rows(reviews(spark, sf_dir), products(spark, sf_dir), "asin")


@query
def dangling_review_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.dangling_keys(reviews(spark, sf_dir), products(spark, sf_dir), "asin")


@query
def dangling_reviews_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.early_dangling_flag(reviews(spark, sf_dir), products(spark, sf_dir), "asin")


@query
def dangling_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.dangling_related(product_texts(spark, sf_dir))


@query
def dangling_related_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.question_7(product_texts(spark, sf_dir)).withColumnRenamed("dangling", "dangling_related")


@query
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return integrity.dangling_rows(described, table(spark, sf_dir, "labels"), "doc_id")


@query
def key_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products without any review."""
    return integrity.key_difference(products(spark, sf_dir), reviews(spark, sf_dir), "asin")


# Nested text


@query
def category_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_nested_list(product_texts(spark, sf_dir).select("asin", "categories"), "categories")
    inner = F.get("categories", F.lit(0))
    return read.select(
        "asin", F.get(inner, F.lit(0)).alias("top"), F.get(inner, F.lit(1)).alias("sub"), "categories_bad"
    )


@query
def related_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_related(product_texts(spark, sf_dir).select("asin", "related"), "related")
    return read.select(
        "asin",
        F.array_join("related.also_viewed", ",").alias("also_viewed"),
        F.array_join("related.bought_together", ",").alias("bought_together"),
        F.array_join(related_ids(F.col("related")), ",").alias("all_ids"),
        "related_bad",
    )


@query
def related_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(questions.related_references(product_texts(spark, sf_dir)), "asin")


# Features


@query
def rating_per_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = features.rating_features(products(spark, sf_dir), reviews(spark, sf_dir))
    return six_digits(as_double(rated, "countRating"))


@query
def rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(tasks.task_1(reviews(spark, sf_dir), products(spark, sf_dir)))


@query
def sales_rank_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = features.category_features(nested_products(spark, sf_dir))
    return as_double(
        ranked.select("asin", "category", "bestSalesCategory", "bestSalesRank"), "bestSalesRank"
    )


@query
def sales_rank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(tasks.task_2(nested_products(spark, sf_dir)))


@query
def also_viewed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.related_prices(nested_products(spark, sf_dir))


@query
def also_viewed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    viewed = features.related_features(nested_products(spark, sf_dir)).drop("related")
    return six_digits(as_double(viewed, "countAlsoViewed"))


@query
def also_viewed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(tasks.task_3(nested_products(spark, sf_dir)))


@query
def imputed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    imputed = features.imputed_features(products(spark, sf_dir))
    return six_digits(imputed.select("asin", "meanImputedPrice", "medianImputedPrice", "unknownImputedTitle"))


@query
def imputed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(tasks.task_4(products(spark, sf_dir)))


# Text and vectors


@query
def title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens(F.col("title"))
    return products(spark, sf_dir).select(
        "asin", F.size(words).alias("n_tokens"), F.array_join(words, "|").alias("tokens")
    )


@query
def document_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = documents(spark, sf_dir).select("doc_id", tokens(F.col("text")).alias("words"))
    return read.select(
        "doc_id",
        F.size("words").alias("n_tokens"),
        F.length(F.array_join("words", "")).alias("n_token_chars"),
    )


@query
def document_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = documents(spark, sf_dir).select(tokens(F.col("text")).alias("words"))
    return vectors.vocabulary(words, "words")


@query
def cosine_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    searched = vectors.vectors_of(embeddings, "vec_id", "embedding", SEARCHED_IDS)
    found = vectors.nearest(
        embeddings, "vec_id", "embedding", {str(name): vector for name, vector in searched.items()}, TOP_K
    )
    return six_digits(found.select("query", "rank", "vec_id", "similarity"))


@query
def word2vec_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of the three most frequent words of the documents."""
    words = documents(spark, sf_dir).select(tokens(F.col("text")).alias("words"))
    counts = written(vectors.vocabulary(words, "words"), "vocabulary")
    asked = [row["word"] for row in counts.orderBy(F.desc("n"), "word").limit(3).collect()]
    model = vectors.fit_word_vectors(words, "words", counts=counts)
    return six_digits(vectors.synonyms(model, asked, TOP_K))


@query
def title_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the titles that stand near each other, with their number and their information."""
    titles = products(spark, sf_dir).select(tokens(F.col("title")).alias("words"))
    return six_digits(cooccurrence.shifted_information(cooccurrence.word_pairs(titles, "words", 3), least=2))


@query
def title_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with the most similar vectors to the five most frequent words of the titles, from counts alone."""
    titles = products(spark, sf_dir).select(tokens(F.col("title")).alias("words"))
    information = cooccurrence.shifted_information(cooccurrence.word_pairs(titles, "words", 3))
    found = written(cooccurrence.factor_vectors(information), "vectors")
    counts = titles.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    asked = [row["word"] for row in counts.join(found, "word", "left_semi").orderBy(F.desc("n"), "word").limit(5).collect()]
    searched = vectors.vectors_of(found, "word", "vector", asked)
    return six_digits(vectors.nearest(found, "word", "vector", searched, TOP_K).select("query", "rank", "word", "similarity"))


@query
def brand_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return encode.index_categories(part, "p_brand", "brand_index")


@query
def brand_one_hot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_brand")
    means = encode.mean_one_hot(part, "p_brand")
    return six_digits(means.select(F.posexplode("meanVector_p_brandOneHot").alias("brand_index", "mean")))


@query
def brand_pca_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the brands' principal components, each turned so that its mean is not negative."""
    part = table(spark, sf_dir, "part").select("p_brand")
    means = category_means(part, "p_brand", k=encode.COMPONENTS)
    return six_digits(means.select(F.posexplode("meanVector_p_brandPCA").alias("component", "mean")))


@query
def type_pca_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loadings of every part type and size in the first components, with the component's share of all rows' variance."""
    part = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_type", "p_size").alias("kind"))
    fitted = fit_components(part, "kind", 5)
    entries = fitted.loadings().select("kind", F.posexplode("loadings").alias("component", "loading"))
    eigenvalues = F.array(*[F.lit(value) for value in fitted.eigenvalues()])
    # Contrasts among kinds with equal counts may be turned within their space; how much of a kind lies in it may not.
    squares = entries.withColumn("eigenvalue", F.round(F.get(eigenvalues, F.col("component")), 9)).groupBy("kind", "eigenvalue")
    return six_digits(squares.agg(F.sum(F.col("loading") * F.col("loading")).alias("square")).where("square > 0.0000005"))


@query
def category_means_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 6 on the products that have a category: mean one-hot vector and mean components."""
    sold = products(spark, sf_dir).where("category <> ''")
    means = tasks.task_6(sold, k=3, invalid="skip")
    parts = [means.select(F.lit(kind).alias("vector"), F.posexplode(f"meanVector_category{kind}").alias("place", "mean")) for kind in ("OneHot", "PCA")]
    return six_digits(parts[0].unionAll(parts[1]))


# Models


@query
def rmse_group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of predicting a line's price by the mean of its return flag: every line is predicted and compared."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("overall"))
    means = lines.groupBy("l_returnflag").agg(F.avg("overall").alias("prediction"))
    return six_digits(trees.rmse(lookup_join(lines, means, "l_returnflag")))


@query
def rmse_group_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same error from the variances within the flags, without predictions."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    price = F.col("l_extendedprice").cast("double")
    flags = lines.groupBy("l_returnflag").agg(F.count(price).alias("n"), F.var_pop(price).alias("variance"))
    return six_digits(flags.agg(F.sqrt(F.sum(F.col("n") * F.col("variance")) / F.sum("n")).alias("rmse")))


@query
def lowest_rmse_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one of four columns whose group means predict a line's price best.

    The squared error within a group is its size times its variance, so one
    aggregate per column and value is enough.
    """
    candidates = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", *[F.col(name).cast("double").alias(name) for name in candidates]
    )
    groups = (
        lines.unpivot("l_extendedprice", list(candidates), "candidate", "value")
        .groupBy("candidate", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.var_pop("l_extendedprice").alias("variance"))
    )
    errors = groups.groupBy("candidate").agg(
        F.sqrt(F.sum(F.col("n") * F.col("variance")) / F.sum("n")).alias("rmse")
    )
    return six_digits(trees.best_candidate(errors, "rmse", "candidate"))


def tree_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test lines; lines with equal keys stay on one side."""
    keys = ("l_orderkey", "l_linenumber")
    lines = spread(
        table(spark, sf_dir, "lineitem").select(*keys, *TREE_FEATURES, F.col("l_extendedprice").alias("overall"))
    )
    assembled = VectorAssembler(inputCols=list(TREE_FEATURES), outputCol="features").transform(lines)
    return trees.split_by_key(assembled.select(*keys, "features", "overall"), *keys)


def level_tree(spark: SparkSession, sf_dir: str, depth: int) -> tuple[level_trees.LevelTree, DataFrame]:
    """A tree on three quarters of the lines, by order key, and the other lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *TREE_FEATURES, F.col("l_extendedprice").alias("overall"))
    held_out = F.pmod(F.col("l_orderkey"), F.lit(4)) == 3
    return level_trees.fit_level_tree(lines.where(~held_out), "overall", TREE_FEATURES, depth=depth), lines.where(held_out)


@query
def level_tree_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error on held-out lines of a tree of depth 2 and of the same tree cut back, from one pass."""
    tree, test = level_tree(spark, sf_dir, 2)
    return six_digits(level_trees.depth_errors(tree, test, "overall", (0, 1, 2)))


@query
def level_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature, cut and prediction of the inner nodes, with the training lines that reach them."""
    tree, _ = level_tree(spark, sf_dir, 2)
    lines = table(spark, sf_dir, "lineitem").where(F.pmod(F.col("l_orderkey"), F.lit(4)) != 3).select(tree.bins().alias("bins"))
    # A line passes the nodes of every depth on its way.
    passed = lines.select(F.explode(F.array_distinct(F.array(*[tree.node(F.col("bins"), d) for d in range(2)]))).alias("node"))
    counts = passed.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    rows = F.array(*[F.struct(F.lit(i).alias("node"), F.lit(f).alias("feature"), F.lit(c).alias("cut"), F.lit(p).alias("prediction")) for i, f, c, p in tree.nodes()])
    named = spark.range(0, 1, numPartitions=1).select(F.inline(rows))
    return six_digits(counts.join(F.broadcast(named), "node"))


@query
def tree_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_digits(tasks.task_7(*tree_lines(spark, sf_dir)))


@query
def tree_depth_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = tree_lines(spark, sf_dir)
    return six_digits(tasks.task_8(train, test, ("l_orderkey", "l_linenumber")))
