"""CSV input with declared types and the missing-value tokens of pandas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.session import session_with
from storelens.sources.csv_records import csv_records

# Text that counts as a missing value, compared without trimming.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("reviewerID", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("overall", T.DoubleType()),
    ]
)
PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("asin", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("categories", T.StringType()),
        T.StructField("related", T.StringType()),
    ]
)


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Null in place of NA tokens in text columns and of NaN in floating columns."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            value = na_to_null(value)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            value = nan_to_null(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = T.StructType(),
    *,
    required: Sequence[str] = (),
    infer: bool = False,
    multiline: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """A CSV file with a header row: all its columns, in its order.

    ``schema`` only says which columns are not text; the others stay text, or with
    ``infer`` become whole or floating numbers where every value present is one (one
    more pass).  Columns named in ``schema`` may be missing, those in ``required`` not.  Text columns keep
    leading zeros, a number that cannot be read is null.  With ``multiline`` quoted values may span
    lines; such files are scanned twice, but in splits like others (see ``csv_records``; lines end with a line feed,
    with or without a carriage return before it).  ``split_bytes`` sets the target
    size of a task's share for this read, in a session of its own.
    """
    if split_bytes is not None:
        spark = session_with(spark, {"spark.sql.files.maxPartitionBytes": str(split_bytes)})
    # Without inference every column is text; only the header is looked at.
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multiline)
    if multiline:
        text = T.StructType([T.StructField(name, T.StringType()) for name in raw.columns])
        parsed = F.from_csv("record", text.toDDL(), {"quote": '"', "escape": '"'})
        raw = csv_records(spark, path).select(parsed.alias("row")).select("row.*")
    missing = [name for name in required if name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {missing[0]}; it has {', '.join(raw.columns)}")
    types = {field.name: field.dataType for field in schema.fields}
    if infer:
        types = _number_types(raw, [name for name in raw.columns if name not in types]) | types
    return raw.select(
        *[na_to_null(F.col(f"`{name}`")).try_cast(types.get(name, T.StringType())).alias(name) for name in raw.columns]
    )


def _number_types(raw: DataFrame, names: Sequence[str]) -> dict[str, T.DataType]:
    """Types of the columns of which every value present is a number (one aggregate)."""
    checks = []
    for k, name in enumerate(names):
        value = na_to_null(F.col(f"`{name}`"))
        for kind in ("bigint", "double"):
            fits = value.isNull() | value.try_cast(kind).isNotNull()
            checks.append((F.bool_and(fits) & (F.count(value) > 0)).alias(f"{kind}{k}"))
    found = raw.agg(*checks).first() if checks else {}
    types: dict[str, T.DataType] = {}
    for k, name in enumerate(names):
        if found[f"bigint{k}"]:
            types[name] = T.LongType()
        elif found[f"double{k}"]:
            types[name] = T.DoubleType()
    return types


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType = T.StructType(),
    *,
    required: Sequence[str] = (),
    infer: bool = False,
    multiline: bool = False,
    split_bytes: int | None = None,
    file_bytes: int = 128 * 1024 * 1024,
) -> DataFrame:
    """Write a CSV table as Parquet once and return the Parquet table.

    The table keeps the splits it was read in; for files whose quoted values span lines ``file_bytes`` sets them
    where ``split_bytes`` does not.
    """
    if multiline and split_bytes is None:
        split_bytes = file_bytes
    table = read_csv(spark, source, schema, required=required, infer=infer, multiline=multiline, split_bytes=split_bytes)
    table.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def development_slice(df: DataFrame, key: str, percent: int) -> DataFrame:
    """A fixed part of the keys with all their rows, for trying out a query.

    The part follows from the MD5 of the key's text, so any engine cuts the same slice.  Rows without a key are left out.
    """
    place = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % 100
    return df.where(place < percent)
