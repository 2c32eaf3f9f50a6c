"""Results on disk: one JSON object per report, one partition per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str, *, runtime: float | None = None) -> None:
    """Write a one-row report as one JSON object, nulls included."""
    if runtime is not None:
        report = report.withColumn("runtime", F.lit(float(runtime)))
    report.repartition(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def save_metrics(metrics: DataFrame, path: str, task: str) -> None:
    """Store a task's metrics under its name; saving again replaces that task only."""
    (
        metrics.withColumn("task", F.lit(task))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("task")
        .parquet(path)
    )


def load_metrics(spark: SparkSession, path: str, task: str) -> DataFrame:
    return spark.read.parquet(f"{path}/task={task}")
