"""Helpers of the training-data operators: shared tables, size-checked joins, row blocks."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
BLOCK_BYTES = 4 * 1024 * 1024
BLOCK_ROWS = 50_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WHILE_STORED = {SHUFFLE_CLEANUP: "true", ARROW_BYTES: str(6 * 1024 * 1024)}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where none is set and all runs in one process, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="storelens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of the queries run inside as each ends, and sends Python small batches; the session's own settings come back after it."""
    before = {name: spark.conf.get(name, None) for name in WHILE_STORED}
    for name, value in WHILE_STORED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends here, and its shuffle files go."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a frame from ``stored``, once nothing that reads it is still to run."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def frame_bytes(df: DataFrame) -> int:
    """Size of a frame's rows in memory, estimated column by column in one aggregate."""
    size = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        else:
            size = size + 8
    with shuffles_removed(df.sparkSession):
        return df.agg(F.sum(size.cast("long")).alias("bytes")).first()["bytes"] or 0


def checked_join(rows: DataFrame, lookup: DataFrame, on: str | list[str], how: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a stored lookup table of measured size up to ``limit``, else shuffle.

    In the shuffled form both sides are plain exchanges, which adaptive execution
    can split where a key is hot.  ``lookup`` should have only atomic columns.
    """
    small = frame_bytes(lookup) <= limit
    return rows.join(F.broadcast(lookup) if small else lookup, on, how)


def release_memory() -> None:
    """Give back to the system what freed arrays hold: Python workers stay for later stages, and each keeps its most otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text, or one row if it is longer, and ``BLOCK_ROWS`` rows."""
    sizes = [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()]
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and (held + size > most or row - start >= BLOCK_ROWS):
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
    release_memory()
