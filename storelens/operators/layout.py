"""Layout of a table's rows over tasks, and tables in between."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table with fewer scan splits than the session has cores.

    For work that is heavy per row on a scanned table in few files.  A table with
    enough splits, as any large one, is given back unchanged and nothing is moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where none is set and all runs in one process, a new temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="storelens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder where nothing is yet; what is written there is removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, removed when the driver ends: it is computed once and its lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
