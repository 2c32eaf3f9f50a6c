"""Product codes of integer vectors, their nearest entries found by a GNAT over each codebook.

The components become integers, floor(256 x), and a vector is cut into equal parts.  Each part has a
codebook of up to 64 entries, which starts with the vectors of the smallest ids and is moved a few rounds to the floored means
of the parts assigned to it.  Codebooks are a few thousand numbers whatever the table's size; all sums are made by Spark.

The nearest entry is found in a geometric near-neighbour access tree (GNAT): every node has
a few split points, each other entry belongs to its nearest split point, and every split point keeps
the least and the largest distance to the entries of every subtree.  A query computes its distance to the split
points of a node and leaves out, at once, every subtree in whose range from some split point no entry
can be as near as the best one so far.  The bounds are square roots widened
by ``SLACK``, a subtree goes only if it is strictly farther, and what is compared in the end are
integers, so that equal distances go to the lower index.

Edge cases: vectors that are null or empty, or hold null or non-finite components, are dropped, and so are those
whose length is not that of the kept vector with the smallest id, or no multiple of the number of
parts, and those with a component beyond ``LARGEST``.  Rows without an id are coded but give no first entries; of
repeated ids the smallest vector is the entry, and every row is coded.  Null labels count as one label.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import checked_join, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Larger components are refused, so that all squared distances fit in 64 bits.
LARGEST = 2.0**16
SPLITS = 8
LEAF = 6
#: Relative error allowed for in a distance; square roots and sums of doubles stay far below it.
SLACK = 1e-9
BLOCK = 4096


@dataclass
class Node:
    """Split points with a subtree each; ``low`` and ``high`` are distances of split i to the subtree of j, itself included."""

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances as integers, (points, entries)."""
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node | np.ndarray:
    """A tree over the rows of ``entries``; a few of them are a leaf, given as their indexes."""
    members = np.arange(len(entries)) if members is None else members
    if len(members) <= LEAF:
        return members
    # Split points far from each other: each next one is the farthest from those before.
    chosen = [0]
    nearest = _distances(entries[members], entries[members[:1]])[:, 0]
    while len(chosen) < min(SPLITS, len(members)):
        far = int(nearest.argmax())
        if nearest[far] == 0:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, _distances(entries[members], entries[members[[far]]])[:, 0])
    if len(chosen) == 1:
        return members  # all equal
    splits = members[chosen]
    squared = _distances(entries[members], entries[splits])
    owner = squared.argmin(axis=1)
    owner[chosen] = np.arange(len(chosen))
    roots = np.sqrt(squared.astype(float))
    low, high = np.zeros((len(splits), len(splits))), np.zeros((len(splits), len(splits)))
    children = []
    for j in range(len(splits)):
        mine = owner == j
        low[:, j] = roots[mine].min(axis=0) * (1 - SLACK)
        high[:, j] = roots[mine].max(axis=0) * (1 + SLACK)
        mine[chosen[j]] = False
        children.append(build(entries, members[mine]))
    return Node(splits, low, high, children)


def nearest_entries(tree: Node | np.ndarray, entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each point's nearest entry, the lowest of equally near ones, and the squared distance."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    index = np.full(len(points), len(entries))
    _search(tree, entries, points, np.arange(len(points)), best, index)
    return index, best


def _offer(rows: np.ndarray, squared: np.ndarray, entry: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    better = (squared < best[rows]) | ((squared == best[rows]) & (entry < index[rows]))
    best[rows[better]], index[rows[better]] = squared[better], entry[better]


def _search(node: Node | np.ndarray, entries: np.ndarray, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
    """Look up the points at ``rows`` in a subtree and better what is known of them."""
    if not len(rows) or not isinstance(node, Node) and not len(node):
        return
    here = node.splits if isinstance(node, Node) else node
    squared = _distances(points[rows], entries[here])
    # Of equally near entries that with the lowest index: the entries are looked at in their order.
    order = np.argsort(here)
    place = order[squared[:, order].argmin(axis=1)]
    _offer(rows, squared[np.arange(len(rows)), place], here[place], best, index)
    if not isinstance(node, Node):
        return
    away = np.sqrt(squared.astype(float))
    # Subtrees of near split points first, as they better the bound for the others.
    visits = np.argsort(away, axis=1, kind="stable")
    for turn in range(len(here)):
        radius = np.sqrt(best[rows].astype(float)) * (1 + SLACK)
        for j in range(len(here)):
            going = visits[:, turn] == j
            if not going.any() or not isinstance(node.children[j], Node) and not len(node.children[j]):
                continue
            d, r = away[going], radius[going, None]
            gone = ((d * (1 - SLACK) - r > node.high[:, j]) | (d * (1 + SLACK) + r < node.low[:, j])).any(axis=1)
            _search(node.children[j], entries, points, rows[going][~gone], best, index)


def integer_vectors(vectors: DataFrame, key: str, vector: str, parts: int = PARTS) -> DataFrame:
    """The rows that are kept, with columns _id and _vec (array of bigint) before those of ``vectors``."""
    raw = F.col(f"`{vector}`").cast("array<double>")
    fine = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST))
    fits = raw.isNotNull() & (F.size(raw) > 0) & (F.size(raw) % parts == 0) & fine
    return vectors.where(F.coalesce(fits, F.lit(False))).select(
        F.col(f"`{key}`").cast("long").alias("_id"), F.transform(raw, lambda x: F.floor(x * SCALE)).alias("_vec"), F.struct("*").alias("_row")
    )


def _matrix(column: pa.ListArray, parts: int) -> np.ndarray:
    """(rows, parts, components of a part) of a column of equally long lists."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), parts, -1)


def _assigned(blocks: np.ndarray, books: np.ndarray, trees: list) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part of each row."""
    found = [[nearest_entries(trees[p], books[p], blocks[a : a + BLOCK, p]) for p in range(len(books))] for a in range(0, len(blocks), BLOCK)]
    if not found:
        return np.zeros((0, len(books)), np.int64), np.zeros((0, len(books)), np.int64)
    return tuple(np.concatenate([np.stack([one[k] for one in block], axis=1) for block in found]) for k in (0, 1))


def fit_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Entries of all parts, (parts, entries, components); None for an empty table.  ``kept`` has _id and _vec, equally long."""
    ids = [row["_id"] for row in kept.select("_id").where(F.col("_id").isNotNull()).distinct().orderBy("_id").limit(entries).collect()]
    if not ids:
        return None
    first = kept.where(F.col("_id") <= ids[-1]).groupBy("_id").agg(F.min("_vec").alias("_vec")).orderBy("_id").toPandas()
    books = np.stack([np.asarray(v, dtype=np.int64) for v in first["_vec"]]).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        shared = kept.sparkSession.sparkContext.broadcast(books)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now = shared.value
            trees = [build(book) for book in now]
            count = np.zeros(now.shape[:2], dtype=np.int64)
            total = np.zeros(now.shape, dtype=np.int64)
            for batch in batches:
                blocks = _matrix(batch.column("_vec"), len(now))
                index, _ = _assigned(blocks, now, trees)
                for p in range(len(now)):
                    count[p] += np.bincount(index[:, p], minlength=now.shape[1])
                    np.add.at(total[p], index[:, p], blocks[:, p])
            part, entry = np.nonzero(count)
            yield pa.record_batch(
                [pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"],
            )

        told = kept.select("_vec").mapInArrow(sums, "part bigint, entry bigint, n bigint, sums array<bigint>")
        wide = books.shape[2]
        # Sums of sums in decimals, which no number of rows overflows.
        merged = told.groupBy("part", "entry").agg(
            F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), *[F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(wide)]
        )
        for row in merged.collect():  # at most one row per entry
            books[row["part"], row["entry"]] = [int(row[f"s{k}"]) // int(row["n"]) for k in range(wide)]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """Kept rows as ``_row`` with ``_id``, their ``_code`` and squared error ``_error``, and the codebooks."""
    kept = integer_vectors(vectors, key, vector, parts)
    # All vectors are to be as long as that of the smallest id.
    lead = kept.where(F.col("_id").isNotNull()).orderBy("_id", "_vec").select(F.size("_vec").alias("length")).first()
    kept = kept.where(F.size("_vec") == F.lit(lead["length"] if lead else -1))
    books = fit_codebooks(kept.select("_id", "_vec"), parts, entries, rounds)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("code string, error bigint")
    def code(column: pd.Series) -> pd.DataFrame:
        now = shared.value
        trees = [build(book) for book in now]
        index, squared = _assigned(np.stack(column.to_numpy()).astype(np.int64).reshape(len(column), len(now), -1), now, trees)
        return pd.DataFrame({"code": [row.tobytes().hex() for row in index.astype(np.uint8)], "error": squared.sum(axis=1)})

    if books is None:
        coded = F.struct(F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = code("_vec")
    return kept.select("_id", "_row", coded.alias("_coded")).select("_id", "_row", F.col("_coded.code").alias("_code"), F.col("_coded.error").alias("_error")), books


def with_label_errors(coded: DataFrame, label: Column) -> DataFrame:
    """``coded`` with the errors summed over equal labels as ``_label_error``; null labels are one label."""
    held = stored(coded.withColumn("_label", label), "coded")
    sums = stored(held.groupBy("_label").agg(F.sum(F.col("_error").cast("decimal(38,0)")).cast("long").alias("_label_error")), "labels")
    known = checked_join(held.where(F.col("_label").isNotNull()), sums.where(F.col("_label").isNotNull()), "_label", "inner")
    none = held.where(F.col("_label").isNull()).withColumn("_label_error", sums.where(F.col("_label").isNull()).select("_label_error").scalar())
    return known.unionByName(none)
