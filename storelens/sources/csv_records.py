"""Records of CSV files whose quoted values span lines, read in splits.

A line break ends a record only outside quotes, and a split cannot know how it begins.  So each
split first says what it would end as if it began at a record or inside quotes: one of the four maps of
two states.  The maps of a file's splits are composed in order by window sums, which tells how each split
begins.  A second scan puts the lines together: records that lie in one split are given out where they are,
what a split has of records that reach over its ends is collected by record.

If the first line of a file ends with a carriage return, all its line breaks are read as plain line feeds, as the
one-task reader does.  Quotes are doubled inside quoted values; a quote inside a value that began without one is an
ordinary sign, and what follows a closing quote up to the next comma belongs to an unquoted value.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.session import session_with


def _line_reader():
    """The function that follows one line, and those that map a split's rows.

    They are local functions only, so they travel to the workers as they are.
    """

    def ends_inside(line: str, inside: bool) -> bool:
        """Whether quotes are open after the line, if they are (or are not) before it."""
        at = 0
        while True:
            if not inside:
                if not line.startswith('"', at):
                    comma = line.find(",", at)
                    if comma < 0:
                        return False
                    at = comma + 1
                    continue
                at += 1
            quote = line.find('"', at)
            if quote < 0:
                return True
            inside = line.startswith('"', quote + 1)
            at = quote + 2
            if not inside:
                comma = line.find(",", quote + 1)
                if comma < 0:
                    return False
                at = comma + 1

    def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
        """Runs of lines of one split; a run may end with its batch."""
        for batch in batches:
            paths, blocks, lines = (batch.column(name).to_pylist() for name in ("path", "block", "value"))
            start = 0
            for k in range(1, len(lines) + 1):
                if k == len(lines) or blocks[k] != blocks[start] or paths[k] != paths[start]:
                    yield (paths[start], blocks[start]), lines[start:k]
                    start = k

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list[bool]] = {}
        returns = set()
        for split, lines in splits(batches):
            if split not in known and split[1] == 0 and lines[0].endswith("\r"):
                returns.add(split)
            ends = known.setdefault(split, [False, True])
            for line in lines:
                if '"' in line:
                    ends[:] = [ends_inside(line, state) for state in ends]
        for (path, block), (plain, quoted) in known.items():
            values = (path, block, plain, quoted, (path, block) in returns)
            yield pa.record_batch([pa.array([value]) for value in values], names=["path", "block", "from_plain", "from_quoted", "returns"])

    def records(inside_at: frozenset, with_returns: frozenset):
        def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, inside, held, begun, given = None, False, [], "", 0
            out: list[tuple] = []

            def tell(whole: bool) -> None:
                # begun: the lines held began in an earlier split; then they are the end or the middle of a record.
                kind = ("whole" if whole else "tail") if begun == "here" else "head"
                out.append((*current, kind, given == 0 and current[1] == 0 and begun == "here", "\n".join(held)))

            for split, lines in splits(batches):
                if split != current:
                    if held:
                        tell(False)
                    current, inside, held, given = split, split in inside_at, [], 0
                    begun = "before" if inside else "here"
                returns = split[0] in with_returns
                for line in lines:
                    held.append(line.removesuffix("\r") if returns else line)
                    if '"' in line:
                        inside = ends_inside(line, inside)
                    if not inside:
                        tell(True)
                        held, begun, given = [], "here", given + 1
                if out:
                    yield batch_of(out)
                    out = []
            if held:
                tell(False)
                yield batch_of(out)

        return assemble

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string())
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["path", "block", "kind", "first", "record"])

    return maps, records


_maps, _records = _line_reader()


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their file and the place of their split.

    In a session of its own that fixes how files are cut, as both scans must meet the same splits even if executors come and go.
    """
    cores = spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)
    spark = session_with(spark, {"spark.sql.files.minPartitionNum": cores})
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def split_states(lines: DataFrame) -> DataFrame:
    """Path and block of the splits that begin ``inside`` quotes, and of the first splits of files whose lines end with carriage ``returns``."""
    ends = lines.mapInArrow(_maps, "path string, block bigint, from_plain boolean, from_quoted boolean, returns boolean")
    # Constant maps set the state, swaps turn it, the identity leaves it.
    constant = F.col("from_plain") == F.col("from_quoted")
    swap = F.col("from_plain") & ~F.col("from_quoted")
    upto = Window.partitionBy("path").orderBy("block")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    turned = ends.withColumn("swaps", F.sum(swap.cast("int")).over(upto))
    placed = turned.withColumns(
        {
            "set": F.last(F.when(constant, F.col("from_plain").cast("int")), ignorenulls=True).over(before),
            "set_at": F.last(F.when(constant, F.col("swaps")), ignorenulls=True).over(before),
            "swaps_before": F.lag("swaps", 1, 0).over(upto),
        }
    )
    zero = F.lit(0)
    state = (F.coalesce("set", zero) + F.col("swaps_before") - F.coalesce("set_at", zero)) % 2
    return placed.select("path", "block", (state == 1).alias("inside"), "returns").where(F.col("inside") | F.col("returns"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Column ``record``: the records of one or more CSV files as text, line breaks within quotes kept, without the header records (runs one job).

    Splits that begin inside quotes are told to all tasks, a path and a number for each, and the files whose first line
    ends with a carriage return; the driver holds as much for every split that it starts a task for.
    """
    lines = lines_of(spark, path)
    states = split_states(lines).collect()
    inside = frozenset((row["path"], row["block"]) for row in states if row["inside"])
    returns = frozenset(row["path"] for row in states if row["returns"])
    found = lines.mapInArrow(_records(inside, returns), "path string, block bigint, kind string, first boolean, record string")
    whole = found.where("kind = 'whole'").select("first", "record")
    if not inside:
        torn = found.where("kind = 'tail'").select("first", "record")  # quotes that are never closed
    else:
        # A tail begins a record, the heads after it go on with it: at most two rows per split are ordered.
        parts = found.where("kind <> 'whole'").withColumn("is_tail", (F.col("kind") == "tail").cast("int"))
        number = F.sum("is_tail").over(Window.partitionBy("path").orderBy("block", "is_tail"))
        torn = parts.withColumn("number", number).groupBy("path", "number").agg(
            F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("block", "is_tail", "record"))).alias("parts")
        ).select("first", F.array_join(F.transform("parts", lambda part: part["record"]), "\n").alias("record"))
    return whole.unionAll(torn).where(~F.col("first") & (F.col("record") != "")).select("record")
