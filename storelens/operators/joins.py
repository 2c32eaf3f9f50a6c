"""Equi-joins of a large row table against a lookup table.

Two plans are used.  A lookup table whose size was measured and is small is
broadcast, so the large side is not moved at all.  Any other lookup table is
joined by a shuffle in which the rows of very frequent keys are dealt out over
several tasks, so that one key with a third of all rows does not end up in one
task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators.layout import written

BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_SPLIT = 2_000_000
FREQUENT_KEYS = 1_000
TRACKED_KEYS = 2_000
SAMPLED = 200
SKETCH_GROUPS = 256

_SPLIT = "_split"
_SPLITS = "_splits"


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame of atomic columns, found with one aggregate (runs a job)."""
    overhead = 16
    row_bytes: Column = F.lit(overhead)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            row_bytes = row_bytes + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + F.lit(overhead)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise ValueError(f"{field.name} is nested; measure a frame of atomic columns")
        else:
            row_bytes = row_bytes + F.lit(8)
    return df.agg(F.sum(row_bytes.cast("long")).alias("bytes")).first()["bytes"] or 0


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    *,
    measure: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Join rows to a lookup table: broadcast if small, otherwise ``split_join``.

    The size is measured on ``measure``, which must be at least as large as the
    lookup table and cheap to scan (for example the table it was aggregated
    from); by default on the lookup table itself.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if measured_bytes(lookup if measure is None else measure) <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), key, how)
    return split_join(rows, lookup, key, how, rows_per_split=rows_per_split)


def frequent_keys(df: DataFrame, key: str, rows: int = ROWS_PER_SPLIT, limit: int = FREQUENT_KEYS) -> dict:
    """Approximate row counts of the keys with more than ``rows`` rows (runs a job).

    One pass with a fixed-size sketch per task, without moving the keys; the
    sketches are merged in groups first, since there is one per scan task.  At
    most ``limit`` keys are given back, the most frequent ones; null counts as a key.
    """
    tracked = F.lit(max(TRACKED_KEYS, limit))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    merged = (
        df.groupBy(group)
        .agg(F.call_function("approx_top_k_accumulate", F.col(key), tracked).alias("_sketch"))
        # A group of its own, as the merge fails on tasks without any sketch.
        .groupBy(F.lit("all"))
        .agg(F.call_function("approx_top_k_combine", F.col("_sketch"), tracked).alias("_sketch"))
    )
    top = merged.select(F.explode(F.call_function("approx_top_k_estimate", F.col("_sketch"), F.lit(limit))).alias("top"))
    return {row["item"]: row["count"] for row in top.select("top.*").where(F.col("count") > rows).collect()}


def hot_keys(df: DataFrame, key: str, rows: int = ROWS_PER_SPLIT, limit: int | None = None) -> DataFrame:
    """A written table of the keys with more than ``rows`` rows and their exact number ``n``; null counts as a key.

    A sample, in which a key of that size is met ``SAMPLED`` times on average, proposes the keys; one aggregate over
    their rows alone then counts them.  A key that the sample misses is only not split.  There are fewer than
    ``1 / rows`` times as many keys as rows, and nothing of them passes through the driver.
    """
    key_column = F.col(f"`{key}`")
    rate = min(1.0, SAMPLED / max(rows, 1))
    keys = df.select(key_column.alias(key))
    if rate < 1.0:
        met = keys.sample(rate, seed=0).groupBy(key).agg(F.count(F.lit(1)).alias("_met")).where(F.col("_met") * 2 >= SAMPLED)
        proposed = written(met.select(key_column.alias("_hot")), "proposed")
        # Bounded by the sample: each proposed key was met half of SAMPLED times.
        keys = keys.join(F.broadcast(proposed), key_column.eqNullSafe(F.col("_hot")), "left_semi")
    counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    if limit is not None:
        counted = counted.orderBy(F.desc("n"), key).limit(limit)
    return written(counted, "hot_keys")


def with_split(rows: DataFrame) -> DataFrame:
    """Replace the number of splits of every row by its split: its place, in the order of all columns, among its task's rows."""
    # Maps have no order, their text has.
    order = [F.col(f"`{f.name}`").cast("string") if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in rows.schema.fields]
    place = F.pmod(F.monotonically_increasing_id(), F.col(_SPLITS)).cast("int")
    return rows.sortWithinPartitions(*order).withColumn(_SPLIT, place).drop(_SPLITS)


def split_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    *,
    rows_per_split: int = ROWS_PER_SPLIT,
    max_frequent: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Shuffle join that deals the rows of each hot key over several tasks.

    The hot keys are counted first.  Without any this is a plain join.  Otherwise each of them, however
    many there are, gets a number of splits in proportion to its count, and its lookup rows are repeated once per split.  The table of hot
    keys is joined to both sides by a broadcast of a size that was measured; should it be larger than
    ``broadcast_bytes``, only keys of twice, four times ... as many rows are split.  All other keys use a plain join.  Rows with
    a null key match nothing and are not moved where they are many.

    The split of a row is its place among the task's rows in the order of all their columns.  Equal rows can stand for
    each other, so the splits do not depend on the order in which a task meets its rows, and a lost task that is run
    again gives the same rows.
    """
    plain = rows.join(lookup, key, how)
    hot = hot_keys(rows, key, rows_per_split, max_frequent)
    if hot.isEmpty():
        return plain
    least = rows_per_split
    while measured_bytes(hot.where(F.col("n") > least)) > broadcast_bytes:
        least *= 2
    kept = hot.where(F.col("n") > least)
    splits = F.broadcast(kept.where(F.col(key).isNotNull()).select(key, F.ceil(F.col("n") / rows_per_split).cast("int").alias(_SPLITS)))
    many_nulls = not kept.where(F.col(key).isNull()).isEmpty()

    marked = (rows.where(F.col(key).isNotNull()) if many_nulls else rows).join(splits, key, "left").select(*rows.columns, _SPLITS)
    cold = marked.where(F.col(_SPLITS).isNull()).drop(_SPLITS).join(lookup, key, how).select(plain.columns)
    dealt = with_split(marked.where(F.col(_SPLITS).isNotNull()))
    repeated = lookup.join(splits, key).withColumn(_SPLIT, F.explode(F.sequence(F.lit(0), F.col(_SPLITS) - 1))).drop(_SPLITS)
    joined = cold.unionAll(dealt.join(repeated, [key, _SPLIT], how).select(plain.columns))
    if many_nulls and how in ("left", "left_anti"):
        alone = rows.where(F.col(key).isNull())
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in plain.schema.fields if f.name not in rows.columns]
        joined = joined.unionAll(alone.select(*[F.col(f"`{name}`") for name in rows.columns], *missing).select(plain.columns))
    return joined


def unique_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col(key).isNotNull())


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Raise if a key occurs twice (runs a job that stops at the first find per task)."""
    example = repeated_keys(df, key).first()
    if example is not None:
        raise ValueError(f"{key} is not unique: {example[key]!r} occurs {example['n']} times")
