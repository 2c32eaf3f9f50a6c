"""Reviews and products seen through the generated star-schema tables.

The generated tables have no nulls, blanks or dangling keys.  These views read
every row of ``part`` and ``lineitem`` and add them by arithmetic on the key: a
dangling key is negative, so it stays dangling at any scale.  The text runs in
Spark and in DuckDB, which lets both start from the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.nested import read_nested

PRODUCTS = """
select cast(p_partkey as string) as asin,
  case when p_partkey % 11 = 0 then null when p_partkey % 13 = 0 then '' else p_name end as title,
  case when p_partkey % 7 = 0 then null else p_retailprice end as price,
  case when p_partkey % 17 = 0 then null when p_partkey % 19 = 0 then '' else p_type end as category
from {part}
"""

REVIEWS = """
select cast(case when (l_linenumber = 7 and l_partkey % 5 = 0) or l_partkey % 29 = 0
            then -1 - l_partkey else l_partkey end as string) as asin,
  case when l_orderkey % 23 = 0 then null else 1.0e0 + (l_quantity % 5) end as overall,
  cast(l_suppkey as string) as reviewer
from {lineitem}
"""

PRODUCT_TEXTS = """
select cast(p_partkey as string) as asin, p_type, p_size,
  case when p_partkey % 7 = 0 then null else p_retailprice end as price,
  case when p_partkey % 17 = 0 then null when p_partkey % 19 = 0 then '[['''']]' when p_partkey % 23 = 0 then '[]'
       else concat('[[''', p_type, ''', ''', p_brand, ''']]') end as categories,
  case when p_partkey % 5 = 0 then null when p_partkey % 6 = 0 then '{{''also_viewed'': []}}'
       when p_partkey % 4 = 1 then concat('{{''also_viewed'': [''', cast(p_partkey + 1 as string), ''']}}')
       else concat('{{''also_viewed'': [''', cast(p_partkey + 1 as string), ''', ''',
                   cast(p_partkey * 2 as string), '''], ''bought_together'': [''',
                   cast(p_partkey + 3 as string), ''']}}') end as related,
  case when p_partkey % 9 = 0 then null when p_partkey % 10 = 0 then '{{}}'
       else concat('{{''', p_type, ''': ', cast(p_size as string), '}}') end as salesrank
from {part}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PRODUCTS, part=table(spark, sf_dir, "part"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REVIEWS, lineitem=table(spark, sf_dir, "lineitem"))


def product_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose nested columns are still text."""
    return spark.sql(PRODUCT_TEXTS, part=table(spark, sf_dir, "part"))


def nested_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with typed nested columns ``categories``, ``related`` and ``salesRank``."""
    texts = product_texts(spark, sf_dir)
    ranks = F.from_json("salesrank", "map<string,int>", {"allowSingleQuotes": "true"})
    typed = texts.withColumn("_ranks", ranks).drop("salesrank").withColumnRenamed("_ranks", "salesRank")
    return read_nested(typed, lists=["categories"], related=["related"])
