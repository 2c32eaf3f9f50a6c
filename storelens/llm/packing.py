"""Packing of documents into token sequences as a cutting-stock problem.

Every document is encoded and cut into pieces of at most the capacity; only the
last piece of a document is shorter.  Piece lengths are rounded up to classes of
``UNIT`` tokens, so that the histogram has a fixed number of bins at any number
of documents.  A linear program over patterns (how many pieces of each class
fill a sequence) covers the histogram with the least number of sequences; its
columns are generated by a knapsack dynamic program priced with the dual
values.  The rounded-down pattern counts leave a rest of a few sequences per
class, which first-fit decreasing packs.  Pieces are ranked within their class,
and the rank says which copy of which pattern a piece belongs to.

Only the histogram (at most capacity / ``UNIT`` rows) reaches the driver, and
only the pattern ranges (one row per class) are broadcast.

Edge cases: a null or empty text is one piece of the end id alone; a text longer
than the capacity fills whole sequences and leaves a last piece; repeated rows
are packed each; equal pieces are interchangeable, their order in a class follows
their key; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.common import blocks, stored
from storelens.llm.word_bpe import encoder

CAPACITY = 2048
UNIT = 8
RANKED_ROWS = 100_000
BLOCK_BYTES = 1 << 20
GAP = 1e-3

Pattern = dict[int, int]


def pieces(text: Column, path: str, end_id: int, capacity: int = CAPACITY, *, with_ids: bool = False) -> Column:
    """Each text's pieces: array of structs start, length, ids_crc32, doc_tokens (and ids)."""
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    ids_type = ",ids:array<int>" if with_ids else ""

    def of_block(texts: pa.Array) -> pa.Array:
        ids, offsets = encoder(path).encode(texts)
        columns: list[list] = [[] for _ in fields]
        bounds = [0]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = np.append(ids[a:b], end_id).astype("<u4")
            for start in range(0, len(own), capacity):
                part = own[start : start + capacity]
                values = [start, len(part), zlib.crc32(part), len(own)] + ([part.astype(np.int32)] if with_ids else [])
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            bounds.append(len(columns[0]))
        structs = pa.StructArray.from_arrays(
            [pa.array(column, kind) for column, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
        )
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), structs)

    @F.arrow_udf(f"array<struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint{ids_type}>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        empty = pa.array([], pa.list_(pa.struct(fields)))
        for batch in batches:
            whole = pa.record_batch([batch], names=["text"])
            yield pa.concat_arrays([of_block(block.column(0)) for block in blocks(whole, "text", BLOCK_BYTES)] or [empty])
        # The worker goes on to other stages, which need its memory.
        encoder(path).known.clear()

    return cut(text)


def _best_pattern(values: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """The knapsack of most value; ``values`` by class 1 .. width, a class of k takes k units."""
    best = np.zeros(width + 1)
    last = np.zeros(width + 1, dtype=np.int64)
    for room in range(1, width + 1):
        # Class k in front of the best filling of what is left.
        tried = values[:room] + best[room - 1 :: -1][:room]
        k = int(tried.argmax())
        if tried[k] > best[room - 1] + 1e-12:
            best[room], last[room] = tried[k], k + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(width), width
    while room > 0:
        if last[room]:
            pattern[last[room] - 1] += 1
            room -= last[room]
        else:
            room -= 1
    return float(best[width]), pattern


def fractional_patterns(demand: np.ndarray, width: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, of the least total that meets the demand exactly.

    Columns are added until the total is proven to be within half a sequence, or
    the share ``gap``, of the least one: by the duals, or by the room all pieces
    take.  Rounding errors of the updates only cost a few sequences, since the plan
    takes no more pieces than there are.  Demands are shifted by tiny amounts, so that no step is of length zero.
    """
    classes = np.flatnonzero(demand)
    demand = demand.astype(float)
    demand[classes] += np.linspace(1e-6, 1e-5, len(classes))
    room = float(demand @ np.arange(1, width + 1)) / width
    full = width // (classes + 1)
    basis = np.diag(full.astype(float))
    inverse = np.diag(1.0 / full)
    used = demand[classes] / full
    while True:
        duals = inverse.sum(axis=0)
        values = np.full(width, -1.0)
        values[classes] = duals
        value, pattern = _best_pattern(np.maximum(values, 0.0), width)
        total = used.sum()
        if value <= 1 + 1e-9 or total - max(total / value, room) < max(0.5, gap * total):
            return _full_columns(basis, classes, width), used
        column = pattern[classes]
        # Sums instead of matrix products, whose threads wait for each other on a busy driver.
        change = (inverse * column).sum(axis=1)
        positive = change > 1e-10
        ratios = np.where(positive, used / np.where(positive, change, 1.0), np.inf)
        out = int(ratios.argmin())
        step = max(ratios[out], 0.0)
        used = np.maximum(used - step * change, 0.0)
        used[out] = step
        basis[:, out] = column
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot


def _full_columns(basis: np.ndarray, classes: np.ndarray, width: int) -> np.ndarray:
    columns = np.zeros((width, basis.shape[1]))
    columns[classes] = basis
    return columns


def packing_plan(demand: np.ndarray, width: int) -> list[tuple[Pattern, int]]:
    """Patterns by class (1 .. width) and their numbers of copies, which use up the demand."""
    plan: list[tuple[Pattern, int]] = []
    rest = demand.astype(np.int64).copy()
    if rest.any():
        columns, used = fractional_patterns(rest, width)
        for k in np.argsort(-used, kind="stable"):
            pattern = {int(c) + 1: int(columns[c, k]) for c in np.flatnonzero(columns[:, k])}
            copies = int(used[k] + 1e-6)
            copies = min([copies, *(rest[c - 1] // n for c, n in pattern.items())])
            if copies > 0:
                plan.append((pattern, int(copies)))
                for c, n in pattern.items():
                    rest[c - 1] -= n * copies
    while rest.any():
        # First-fit decreasing, as many copies at once as the rest allows.
        pattern, room = {}, width
        for c in np.flatnonzero(rest)[::-1]:
            n = min(int(rest[c]), room // (int(c) + 1))
            if n:
                pattern[int(c) + 1] = n
                room -= n * (int(c) + 1)
        copies = min(int(rest[c - 1]) // n for c, n in pattern.items())
        plan.append((pattern, copies))
        for c, n in pattern.items():
            rest[c - 1] -= n * copies
    return plan


def _ranges(plan: list[tuple[Pattern, int]]) -> list[tuple[int, list[int], list[int], list[int]]]:
    """For each class the first ranks, first sequences and pieces per sequence of its patterns."""
    by_class: dict[int, tuple[list[int], list[int], list[int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, copies in plan:
        for c, n in pattern.items():
            starts, bases, each = by_class.setdefault(c, ([], [], []))
            starts.append(taken.get(c, 0))
            bases.append(sequence)
            each.append(n)
            taken[c] = taken.get(c, 0) + n * copies
        sequence += copies
    return [(c, *lists) for c, lists in sorted(by_class.items())]


_RANGES = T.StructType(
    [T.StructField("_class", T.LongType())]
    + [T.StructField(name, T.ArrayType(T.LongType())) for name in ("_starts", "_bases", "_each")]
)
_ARROW_RANGES = pa.schema([("_class", pa.int64())] + [(name, pa.list_(pa.int64())) for name in ("_starts", "_bases", "_each")])


def pack(
    docs: DataFrame, path: str, end_id: int, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, unit: int = UNIT,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    body = F.col(f"`{text}`")
    cut = docs.select(F.col(f"`{key}`").alias(key), F.inline(pieces(body, path, end_id, capacity, with_ids=with_ids)))
    cut = stored(cut.withColumn("_class", F.ceil(F.col("length") / unit)), "pieces")

    width = capacity // unit
    demand = np.zeros(width, dtype=np.int64)
    for row in cut.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per class at most
        demand[row["_class"] - 1] = row["n"]
    # As an Arrow table: a list of rows would start Python workers of another kind, which stay.
    made = [dict(zip(_RANGES.names, row, strict=True)) for row in _ranges(packing_plan(demand, width))]
    ranges = docs.sparkSession.createDataFrame(pa.Table.from_pylist(made, _ARROW_RANGES), _RANGES)

    # Ranks within a class: within each of its parts, then behind the parts before it.
    parts = max(1, -(-int(demand.sum()) // RANKED_ROWS))
    place = F.pmod(F.xxhash64(key, "start"), F.lit(parts))
    dealt = cut.withColumn("_part", place)
    sizes = dealt.groupBy("_class", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_class", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_class", "_part").orderBy(key, "start", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["_class", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))

    placed = ranked.join(F.broadcast(ranges), "_class")
    at = F.size(F.filter("_starts", lambda s: s <= F.col("_rank")))
    inside = F.col("_rank") - F.element_at("_starts", at)
    sequence = F.element_at("_bases", at) + F.floor(inside / F.element_at("_each", at))
    placed = placed.withColumn("sequence_id", sequence.cast("long"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), key, "start", "ids_crc32")
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if with_ids else [])
    return placed.withColumn("offset", offset).select(key, *names)
