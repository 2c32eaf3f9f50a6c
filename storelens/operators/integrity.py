"""Referential integrity between a table and the keys of a parent table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.joins import BROADCAST_BYTES, lookup_join, measured_bytes, unique_keys


def match_marks(rows: DataFrame, parents: DataFrame, key: str, name: str = "matched") -> DataFrame:
    """Every row with a flag that says whether its key exists in the parent table.

    A null key matches nothing.
    """
    lookup = unique_keys(parents, key).withColumn(name, F.lit(True))
    joined = lookup_join(rows, lookup, key, "left", measure=parents.select(key))
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def dangling_rows(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is present but has no parent."""
    return lookup_join(
        rows.where(F.col(key).isNotNull()),
        unique_keys(parents, key),
        key,
        "left_anti",
        measure=parents.select(key),
    )


def dangling_keys(
    rows: DataFrame, parents: DataFrame, key: str, name: str = "n", *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Keys without a parent, with their number of rows.

    Against few parents the rows are filtered where they are.  Otherwise both
    sides are reduced to one row per key and task before they are moved, so the
    size of a key's group does not matter.
    """
    keys = rows.select(key).where(F.col(key).isNotNull())
    if measured_bytes(parents.select(key)) <= broadcast_bytes:
        orphans = keys.join(F.broadcast(unique_keys(parents, key)), key, "left_anti")
        return orphans.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return _keys_of_rows_only(keys, parents, key, name)


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of the left table that the right table lacks."""
    keys = left.select(key).where(F.col(key).isNotNull())
    return _keys_of_rows_only(keys, right, key, "_n").select(key)


def _keys_of_rows_only(keys: DataFrame, parents: DataFrame, key: str, name: str) -> DataFrame:
    """One aggregate over both tables.

    Two aggregates and an anti join mean the same, but Spark may move that join
    below the aggregate of the rows and then shuffle every row.
    """
    known = parents.select(key, F.lit(True).alias("_parent")).where(F.col(key).isNotNull())
    both = keys.withColumn("_parent", F.lit(False)).unionByName(known)
    counted = both.groupBy(key).agg(
        F.count_if(~F.col("_parent")).alias(name), F.bool_or("_parent").alias("_parent")
    )
    return counted.where(~F.col("_parent")).drop("_parent")


def _missing(rows: DataFrame, parents: DataFrame, key: str, broadcast_bytes: int) -> DataFrame:
    """Some keys without a parent, enough to tell whether there are any."""
    keys = rows.select(key).where(F.col(key).isNotNull())
    if measured_bytes(parents.select(key)) <= broadcast_bytes:
        # Nothing is moved before a following limit, so each task ends at its first find.
        return keys.join(F.broadcast(unique_keys(parents, key)), key, "left_anti")
    return _keys_of_rows_only(keys, parents, key, "_n").select(key)


def dangling_flag(
    rows: DataFrame, parents: DataFrame, key: str, name: str = "dangling", *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """One row with 1 if any key has no parent, otherwise 0; as a plan, which looks at every partition."""
    first = _missing(rows, parents, key, broadcast_bytes).limit(1)
    return first.agg(F.count(F.lit(1)).cast("int").alias(name))


def early_dangling_flag(
    rows: DataFrame, parents: DataFrame, key: str, name: str = "dangling", *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``dangling_flag`` looked up at once: the scan ends with the first find (see ``has_dangling``)."""
    found = has_dangling(rows, parents, key, broadcast_bytes=broadcast_bytes)
    return rows.sparkSession.range(0, 1, numPartitions=1).select(F.lit(int(found)).alias(name))


def has_dangling(
    rows: DataFrame, parents: DataFrame, key: str, *, broadcast_bytes: int = BROADCAST_BYTES
) -> bool:
    """The flag as a Python bool.

    Against few parents the partitions of the rows are scanned in growing batches, one at first, until one has a
    find, so that a table with dangling keys throughout costs one task.
    """
    # Not isEmpty(), which would cut every partition to one row first.
    return bool(_missing(rows, parents, key, broadcast_bytes).take(1))


def listed_keys(df: DataFrame, items: Column, key: str) -> DataFrame:
    """One row per non-null element of a list column."""
    return df.select(F.explode(items).alias(key)).where(F.col(key).isNotNull())
