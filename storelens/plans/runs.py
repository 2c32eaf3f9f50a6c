"""Complete runs: from the input tables to stored results."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from storelens.operators.vectors import PARTITIONS
from storelens.plans import questions, tasks
from storelens.sources.csv_tables import PRODUCT_SCHEMA, REVIEW_SCHEMA, csv_to_parquet, read_csv
from storelens.sources.sinks import save_metrics, write_report


def profile_csv_files(
    spark: SparkSession,
    reviews_csv: str,
    products_csv: str,
    out: str,
    *,
    work_dir: str | None = None,
    infer: bool = False,
    multiline: bool = False,
    split_bytes: int | None = None,
) -> None:
    """Read both CSV files with all their columns, answer questions 1 to 7, write one JSON object.

    The report reads its tables several times.  With ``work_dir``, a folder that
    all executors can reach, they are first turned into Parquet there (in a new folder of each run), which is
    the way for large files; otherwise they are kept by the executors meanwhile.
    ``multiline`` is for files whose quoted values span lines, ``split_bytes`` the size of a task's share.
    """
    started = time.monotonic()
    options = {"infer": infer, "multiline": multiline, "split_bytes": split_bytes}
    files = (
        ("reviews", reviews_csv, REVIEW_SCHEMA, ("asin", "overall")),
        ("products", products_csv, PRODUCT_SCHEMA, ("asin", "price", "categories", "related")),
    )
    if work_dir is not None:
        folder = f"{work_dir}/{uuid.uuid4().hex}"
        tables = [
            csv_to_parquet(spark, path, f"{folder}/{name}", schema, required=needed, **options)
            for name, path, schema, needed in files
        ]
        _answer(*tables, out, started)
        return

    kept = [
        read_csv(spark, path, schema, required=needed, **options).persist(StorageLevel.MEMORY_AND_DISK)
        for _, path, schema, needed in files
    ]
    try:
        _answer(*kept, out, started)
    finally:
        for table in kept:
            table.unpersist()


def _answer(reviews: DataFrame, products: DataFrame, out: str, started: float) -> None:
    report = questions.report(reviews, products)
    answers = report.collect()  # the one JSON object that is asked for
    computed = reviews.sparkSession.createDataFrame(answers, report.schema)
    write_report(computed, out, runtime=time.monotonic() - started)


def feature_tasks(reviews: DataFrame, products: DataFrame, out: str) -> None:
    """Run tasks 1 to 4 on typed tables and store their metrics by task name."""
    save_metrics(tasks.task_1(reviews, products), out, "task_1")
    save_metrics(tasks.task_2(products), out, "task_2")
    save_metrics(tasks.task_3(products), out, "task_3")
    save_metrics(tasks.task_4(products), out, "task_4")


def vector_tasks(
    processed: DataFrame, words: Sequence[str], out: str, *, k: int = 15, partitions: int = PARTITIONS
) -> None:
    """Run tasks 5 and 6 on products with a title and a category; word vectors train in so many partitions."""
    save_metrics(tasks.task_5(processed, words, partitions=partitions), out, "task_5")
    save_metrics(tasks.task_6(processed, k=k), out, "task_6")


def model_tasks(train: DataFrame, test: DataFrame, out: str, split_keys: Sequence[str] = ()) -> None:
    """Run tasks 7 and 8 on rows with features and a rating."""
    save_metrics(tasks.task_7(train, test), out, "task_7")
    save_metrics(tasks.task_8(train, test, split_keys), out, "task_8")
