"""Session settings shared by the tests, the benchmark and notebooks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "12g", app: str = "storelens") -> SparkSession:
    """A single-machine session.  On a cluster use the session the cluster gives."""
    shuffle_partitions = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session on the same cluster with the settings of the given one and some of its own."""
    other = spark.newSession()
    for name, value in (spark.conf.getAll | settings).items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other
