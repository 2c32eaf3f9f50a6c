from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import types as T

from storelens.operators.profile import null_percents, null_percents_long
from storelens.sources import csv_tables, sinks

TEXT = '''price,asin,title
1.5,007,"a, b"
NA,008,"say ""hi"""
NaN,009,"two
lines"
null,010,N/A
,011,""
x,012, NA
2,NULL,none
'''
SCHEMA = T.StructType(
    [T.StructField("asin", T.StringType()), T.StructField("title", T.StringType()), T.StructField("price", T.DoubleType())]
)


@pytest.fixture()
def csv_file(tmp_path):
    path = tmp_path / "products.csv"
    path.write_text(TEXT)
    return str(path)


def test_read_csv(spark, csv_file):
    rows = [tuple(row) for row in csv_tables.read_csv(spark, csv_file, SCHEMA, multiline=True).select("asin", "title", "price").collect()]
    assert rows == [
        ("007", "a, b", 1.5),
        ("008", 'say "hi"', None),
        ("009", "two\nlines", None),
        ("010", None, None),
        ("011", None, None),
        ("012", " NA", None),
        (None, "none", 2.0),
    ]


def test_read_csv_misses_the_same_values_as_pandas(spark, csv_file):
    mine = csv_tables.read_csv(spark, csv_file, SCHEMA, multiline=True).select("asin", "title", "price").toPandas().isna()
    theirs = pd.read_csv(csv_file, dtype={"asin": "object"})
    theirs["price"] = pd.to_numeric(theirs["price"], errors="coerce")
    assert (mine.to_numpy() == theirs[["asin", "title", "price"]].isna().to_numpy()).all()


def test_every_token_is_missing(spark, tmp_path):
    path = tmp_path / "tokens.csv"
    pd.DataFrame({"asin": list(csv_tables.NA_TOKENS), "n": range(len(csv_tables.NA_TOKENS))}).to_csv(path, index=False)
    schema = T.StructType([T.StructField("asin", T.StringType())])
    assert csv_tables.read_csv(spark, str(path), schema).where("asin is not null").count() == 0
    assert pd.read_csv(path)["asin"].isna().all()


def test_split_reading(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    with open(path, "w") as out:
        out.write("reviewerID,asin,overall\n")
        out.writelines(f"r{i},{i:06d},{i % 5 + 1}\n" for i in range(20_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = csv_tables.read_csv(spark, str(path), csv_tables.REVIEW_SCHEMA, split_bytes=64 * 1024)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert df.rdd.getNumPartitions() > 3
    assert df.count() == 20_000
    assert df.where("asin is null or overall is null").count() == 0
    assert df.select("asin").distinct().count() == 20_000


def test_all_columns_with_given_and_inferred_types(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("asin,a.b,n,mixed,empty,price\n007,1.5,1,1,,2\n008,NA,2,x,NA,y\n")
    text = csv_tables.read_csv(spark, str(path), csv_tables.PRODUCT_SCHEMA)
    assert dict(text.dtypes) == {"asin": "string", "a.b": "string", "n": "string", "mixed": "string", "empty": "string", "price": "double"}
    typed = csv_tables.read_csv(spark, str(path), csv_tables.PRODUCT_SCHEMA, infer=True)
    assert dict(typed.dtypes) == dict(text.dtypes) | {"a.b": "double", "n": "bigint"}
    assert [tuple(row) for row in typed.collect()] == [("007", 1.5, 1, "1", None, 2.0), ("008", None, 2, "x", None, None)]
    assert null_percents(typed).first()["a.b"] == 50.0
    assert {r["column"]: r["null_percent"] for r in null_percents_long(typed).collect()}["empty"] == 100.0
    assert csv_tables.missing_to_null(typed).columns == typed.columns


def test_missing_column(spark, csv_file):
    with pytest.raises(ValueError, match="no column categories"):
        csv_tables.read_csv(spark, csv_file, csv_tables.PRODUCT_SCHEMA, required=["asin", "categories"])


def test_csv_to_parquet(spark, csv_file, tmp_path):
    table = csv_tables.csv_to_parquet(spark, csv_file, str(tmp_path / "parquet"), SCHEMA, multiline=True, file_bytes=30)
    assert table.count() == 7
    assert len(list(Path(tmp_path / "parquet").glob("part-*"))) > 1


def test_missing_to_null(spark):
    df = spark.createDataFrame([("NA", float("nan"), 1), ("na", 2.0, None)], "a string, b double, c int")
    assert [tuple(row) for row in csv_tables.missing_to_null(df).collect()] == [(None, None, 1), ("na", 2.0, None)]


def test_development_slice(spark):
    df = spark.range(0, 2_000).selectExpr("id % 500 as k", "id")
    part = csv_tables.development_slice(df, "k", 20)
    keys = part.select("k").distinct().count()
    assert 60 < keys < 140
    assert part.count() == keys * 4
    again = csv_tables.development_slice(df.repartition(7), "k", 20)
    assert again.join(part, "id", "left_anti").count() == 0


def test_save_metrics_replaces_one_task(spark, tmp_path):
    path = str(tmp_path / "metrics")
    sinks.save_metrics(spark.createDataFrame([(1, 2.0)], "a int, b double"), path, "task_1")
    sinks.save_metrics(spark.createDataFrame([(["x"],)], "words array<string>"), path, "task_5")
    sinks.save_metrics(spark.createDataFrame([(3, 4.0)], "a int, b double"), path, "task_1")
    assert [tuple(row) for row in sinks.load_metrics(spark, path, "task_1").collect()] == [(3, 4.0)]
    assert sinks.load_metrics(spark, path, "task_5").first()["words"] == ["x"]


def test_write_report(spark, tmp_path):
    report = spark.createDataFrame([({"a": 1}, None, 0)], "q5 map<string,int>, q3 double, q6 int")
    sinks.write_report(report, str(tmp_path / "report"), runtime=1.5)
    (part,) = Path(tmp_path / "report").glob("part-*")
    assert json.loads(part.read_text()) == {"q5": {"a": 1}, "q3": None, "q6": 0, "runtime": 1.5}
