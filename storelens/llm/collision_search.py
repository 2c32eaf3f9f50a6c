"""Nearest neighbours by collision-counting hashing with query-centred windows.

Every vector is projected on ``PROJECTIONS`` random lines; per line and block of vectors the
projections are sorted.  A query opens a window around its own projection
on every line and widens all windows step by step (virtual rehashing: no hash table is built
anew for a larger radius).  A vector collides on a line when it comes into the
window there.  Those that collide on ``THRESHOLD`` of the lines are candidates; the windows are
widened until a share ``VERIFIED`` of the block's vectors are (and ``LEAST_VERIFIED``), and all candidates are verified
by their exact distance in double precision.

Vectors and queries are dealt over a grid of blocks, each cell one task's group;
each cell gives its nearest per query, and the nearest of all cells are ranked.

Edge cases: vectors that are null, empty, zero or not finite take no part,
neither do rows without an id; rows of one id count as one, with the least
vector; vectors of different lengths are not compared; ties go to the smaller
id.  With fewer candidates than asked all are given; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import stored
from storelens.llm.vectors import as_doubles, usable

PROJECTIONS = 160
THRESHOLD = 0.6
VERIFIED = 0.1
LEAST_VERIFIED = 200
WIDEN = 1.2
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
SEED = 20_240_501

_RESULT = "query_id bigint, id bigint, score double"


def _search_block(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest found of a block for each query."""
    n, lines = len(data), PROJECTIONS
    axes = np.random.default_rng([SEED, data.shape[1]]).standard_normal((data.shape[1], lines))
    placed, asked = data @ axes, queries @ axes
    order = np.argsort(placed, axis=0, kind="stable")
    # All sorted lines in one array, each moved beyond the one before it, so that one search places all ends of all windows.
    gap = 4.04 * max(float(np.abs(placed).max(initial=0.0)), float(np.abs(asked).max(initial=0.0))) or 1.0
    moves = np.arange(lines) * gap
    ranked = (np.take_along_axis(placed, order, axis=0).T + moves[:, None]).reshape(-1)
    flat = np.ascontiguousarray(order.T).reshape(-1)
    least = int(np.ceil(THRESHOLD * lines))
    enough = min(n, max(LEAST_VERIFIED, int(np.ceil(VERIFIED * n))) + k + 1)
    first, last = np.arange(lines) * n, (np.arange(lines) + 1) * n
    spread = float(placed.std()) or 1.0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query_id, query, center in zip(query_ids.tolist(), queries, asked + moves, strict=True):
        low = high = np.searchsorted(ranked, center)
        counts = np.zeros(n, dtype=np.int64)
        width = 0.25 * spread
        while True:
            # The next ring of every window: left and right of what it holds, never beyond its line.
            reach = min(width, 0.24 * gap)
            new_low = np.minimum(np.maximum(np.searchsorted(ranked, center - reach), first), low)
            new_high = np.maximum(np.minimum(np.searchsorted(ranked, center + reach, side="right"), last), high)
            if reach < width:
                new_low, new_high = first, last
            rings = zip(np.concatenate([new_low, high]).tolist(), np.concatenate([low, new_high]).tolist(), strict=True)
            counts += np.bincount(np.concatenate([flat[begin:end] for begin, end in rings]), minlength=n)
            low, high = new_low, new_high
            candidates = np.flatnonzero(counts >= least)
            if len(candidates) >= enough or bool((high - low == n).all()):
                break
            width *= WIDEN
        candidates = candidates[ids[candidates] != query_id]
        scores = np.sqrt(((data[candidates] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[candidates], scores))[:k]
        found.append((np.full(len(best), query_id), ids[candidates][best], scores[best]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
    return pd.DataFrame(dict(zip(("query_id", "id", "score"), columns, strict=True)))


def nearest(
    vectors: DataFrame, is_query: Column, k: int, *, key: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k nearest found of each query: query_id, rank, id, score; ``is_query`` is a condition on the column id."""
    rows = as_doubles(vectors, key, vector).where(usable(F.col("vec")) & F.col("id").isNotNull())
    rows = stored(rows.groupBy("id").agg(F.min("vec").alias("vec")), "vectors").withColumn("dim", F.size("vec"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries")).first()
    blocks = max(1, -(-sizes["n"] // block_rows))
    query_blocks = max(1, -(-sizes["queries"] // query_rows))
    place = F.xxhash64("id")
    data = rows.select("id", "vec", "dim", F.pmod(place, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("part"))
    asked = rows.where(is_query).select(
        "id", "vec", "dim", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(place, F.lit(query_blocks)).cast("int").alias("part"),
    )
    cells = data.withColumn("asked", F.lit(False)).unionByName(asked.withColumn("asked", F.lit(True)))

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        asks = cell["asked"].to_numpy(bool)
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        ids, points = cell["id"].to_numpy(np.int64), np.stack(cell["vec"].to_numpy())
        return _search_block(ids[~asks], points[~asks], ids[asks], points[asks], k)

    found = cells.groupBy("dim", "block", "part").applyInPandas(search, _RESULT)
    order = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
