"""Near-duplicate vectors by a robust-pruned flat graph over overlapping shards.

Equal vectors are merged into one node with their number.  Cluster centres are
fitted on a bounded sample (``SAMPLE_ROWS``); every node goes to its nearest centres (the first of ``WIDTHS``
says how many, and how near they must be to the best), so that shards overlap.  In
each shard a node gets the nearest nodes that no nearer neighbour occludes (robust pruning
with ``ALPHA``) and some distant ones; links go both ways.  The lists of a node from all its
shards are united.  Every node is then searched for in its shards on the united graph: greedily from the
shard's medoid and its own place, and from everything found within the range
outwards until the range holds no unvisited neighbour.  What is found is verified
by its cosine in double precision.

A shard of more than ``SHARD_ROWS`` nodes is dealt over parts.  A group holds the nodes of one
part that stand and those of one part that are searched for, so that no group grows without bound;
what a block of queries finds is verified, counted and folded into the forest at once.  A pair is
counted in the first shard both are in.  The links of ``AUDIT_ROWS`` nodes are then counted against all nodes: if the lower bound of
the recall is below ``LEAST_RECALL``, all is done again with the next, wider, overlap; after the last one a warning names the recall.  For the components each group gives a spanning forest of the
links found, no pairs.

Edge cases: vectors that are null, empty, zero or not finite, and rows without an id, link with nothing;
vectors of different lengths neither; equal vectors link with each other; repeated rows of an id count as rows.  An empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import checked_join, stored
from storelens.llm.components import components
from storelens.llm.vectors import as_doubles, usable

LEAST_COSINE = 0.9
SAMPLE_ROWS = 20_000
ROWS_PER_SHARD = 1_000
MOST_SHARDS = 1_024
#: Shards of a node, and how much less similar than the nearest centre they may be: the next pair is tried if the audit fails.
WIDTHS = ((3, 0.05), (8, 0.15), (16, 0.3), (32, 0.5))
AUDIT_ROWS = 1_000
LEAST_RECALL = 0.95
SHARD_ROWS = 6_000
ALPHA = 1.2
POOL = 32
NEAR = 20
FAR = 6
BEAM = 16
QUERY_BLOCK = 256
SEED = 7


def _unit(points: np.ndarray) -> np.ndarray:
    largest = np.abs(points).max(axis=1, keepdims=True)
    points = points / largest
    return points / np.sqrt((points**2).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, shards: int, rounds: int = 6) -> np.ndarray:
    """Unit cluster centres of unit vectors, by a few rounds of spherical k-means."""
    centres = sample[np.random.default_rng(SEED).permutation(len(sample))[:shards]]
    for _ in range(rounds):
        # Sums instead of matrix products, whose threads wait for each other on a busy driver.
        nearest = np.concatenate([np.einsum("nd,kd->nk", part, centres).argmax(axis=1) for part in np.array_split(sample, max(1, len(sample) // 1000))])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        filled = (sums != 0).any(axis=1)
        centres = np.where(filled[:, None], _unit(np.where(filled[:, None], sums, 1.0)), centres)
    return centres


def _links(points: np.ndarray) -> np.ndarray:
    """Neighbours by place (padded with -1): pruned near ones and some far ones."""
    n = len(points)
    near = min(POOL, n - 1)
    if near < 1:
        return np.full((n, 1), -1)
    rng = np.random.default_rng([SEED, n])
    lists = []
    for begin in range(0, n, 512):
        block = points[begin : begin + 512]
        rows = np.arange(len(block))
        sims = block @ points.T
        sims[rows, begin + rows] = -np.inf
        pool = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        own = np.take_along_axis(sims, pool, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        pool, own = np.take_along_axis(pool, order, axis=1), np.take_along_axis(own, order, axis=1)
        among = points[pool]
        between = np.sqrt(np.maximum(2 - 2 * (among @ among.transpose(0, 2, 1)), 0))
        away = np.sqrt(np.maximum(2 - 2 * own, 0))
        alive = np.ones(pool.shape, dtype=bool)
        chosen = np.full((len(block), NEAR), -1)
        for slot in range(NEAR):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            chosen[some, slot] = pool[rows[some], first[some]]
            # Gone: the chosen one, and all that it is much nearer to than the node is.
            alive &= ~((ALPHA * between[rows, first] <= away) & some[:, None])
            alive[rows, first] = False
        lists.append(np.concatenate([chosen, rng.integers(0, n, (len(block), FAR))], axis=1))
    return np.concatenate(lists)


def _both_ways(links: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists with the links of both ends."""
    n = len(links)
    a, b = np.repeat(np.arange(n), links.shape[1]), links.reshape(-1)
    kept = (b >= 0) & (a != b)
    a, b = a[kept], b[kept]
    codes = np.unique(np.concatenate([a * n + b, b * n + a]))
    return np.split(codes % n, np.searchsorted(codes // n, np.arange(1, n)))


def _search(points: np.ndarray, table: np.ndarray, queries: np.ndarray, own: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) found within the range, by block of queries; ``own`` is the query's node, or -1."""
    n = len(points)
    centre = points.mean(axis=0)
    medoid = int((points @ centre).argmax())
    for begin in range(0, len(queries), QUERY_BLOCK):
        asked = queries[begin : begin + QUERY_BLOCK]
        size = len(asked)
        rows = np.arange(size)
        seen = np.zeros((size, n), dtype=bool)
        inside = np.zeros((size, n), dtype=bool)
        starts = np.stack([np.full(size, medoid), np.where(own[begin : begin + size] >= 0, own[begin : begin + size], medoid)], axis=1)
        pool = np.full((size, BEAM), -1)
        sims = np.full((size, BEAM), -np.inf)
        opened = np.ones((size, BEAM), dtype=bool)

        def visit(query: np.ndarray, node: np.ndarray, seen=seen, inside=inside, asked=asked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Similarities of nodes not seen before, each once."""
            codes = query * n + node
            if len(codes) * 32 > seen.size:
                marked = np.zeros(seen.size, dtype=bool)
                marked[codes] = True
                codes = np.flatnonzero(marked & ~seen.reshape(-1))
            else:
                codes = np.unique(codes)
                codes = codes[~seen.reshape(-1)[codes]]
            query, node = codes // n, codes % n
            seen[query, node] = True
            values = np.einsum("id,id->i", asked[query], points[node])
            inside[query, node] = values >= least - 1e-4
            return query, node, values

        query, node, values = visit(np.repeat(rows, 2), starts.reshape(-1))
        while True:
            # Keep the best of the pool and the new ones.
            counts = np.bincount(query, minlength=size)
            width = int(counts.max()) if len(query) else 0
            if width:
                column = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
                more, more_sims = np.full((size, width), -1), np.full((size, width), -np.inf)
                more[query, column], more_sims[query, column] = node, values
                pool, sims = np.concatenate([pool, more], axis=1), np.concatenate([sims, more_sims], axis=1)
                opened = np.concatenate([opened, more < 0], axis=1)
                order = np.argsort(-sims, axis=1, kind="stable")[:, :BEAM]
                pool, sims, opened = (np.take_along_axis(x, order, axis=1) for x in (pool, sims, opened))
            closed = ~opened
            if not closed.any():
                break
            first = closed.argmax(axis=1)
            going = closed[rows, first]
            opened[rows, first] = True
            next_nodes = table[pool[rows[going], first[going]]]
            filled = next_nodes >= 0
            query, node, values = visit(np.repeat(rows[going], filled.sum(axis=1)), next_nodes[filled])
        # Outwards from all that is within the range.
        wave = inside.copy()
        while wave.any():
            query, node = np.nonzero(wave)
            wave[:] = False
            for part in range(0, len(query), 50_000):
                next_nodes = table[node[part : part + 50_000]]
                filled = next_nodes >= 0
                q, v, s = visit(np.repeat(query[part : part + 50_000], filled.sum(axis=1)), next_nodes[filled])
                hit = s >= least - 1e-4
                wave[q[hit], v[hit]] = True
        query, node = np.nonzero(inside)
        yield query + begin, node


def _forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The least place reachable from each place by the links (a, b) and those to ``labels``."""
    a, b = np.concatenate([a, np.arange(len(labels))]), np.concatenate([b, labels])
    while True:
        least = labels.copy()
        np.minimum.at(least, a, labels[b])
        np.minimum.at(least, b, labels[a])
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least


def dealt(ready: DataFrame) -> DataFrame:
    """Each node stands in the cell of its part, for every block, and is asked in the block of its part, for every cell."""
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    kept = ["node", "vec", "n", "shards", "shard"]
    stands = ready.withColumn("block", every).select(
        *kept, "near", F.col("part").alias("cell"), "block", F.lit(True).alias("stands"), (F.col("block") == F.col("part")).alias("asks")
    )
    asks = ready.where("parts > 1").withColumn("cell", every).where("cell <> part").select(
        *kept, F.lit(None).cast("array<bigint>").alias("near"), "cell", F.col("part").alias("block"), F.lit(False).alias("stands"), F.lit(True).alias("asks")
    )
    return stands.unionAll(asks)


def audit(nodes: DataFrame, found: DataFrame, least: float, rows: int = AUDIT_ROWS) -> tuple[int, int]:
    """Links found and links there are of the ``rows`` nodes with the least hash, against all nodes (one aggregate)."""
    asked = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").select("node", "vec").limit(rows).toPandas()
    by_length = {}
    for length in sorted({len(v) for v in asked["vec"]}):
        mine = asked[asked["vec"].map(len) == length]
        by_length[length] = (mine["node"].to_numpy(np.int64), _unit(np.stack(mine["vec"].to_numpy())))
    shared = nodes.sparkSession.sparkContext.broadcast(by_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = 0
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("vec")).to_numpy(zero_copy_only=False)
            for length, (names, queries) in shared.value.items():
                rows = np.flatnonzero(size == length)
                for begin in range(0, len(rows), 2048):
                    some = batch.take(pa.array(rows[begin : begin + 2048]))
                    points = _unit(some.column("vec").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(some.num_rows, length))
                    others = some.column("node").to_numpy()[:, None] != names[None, :]
                    linked = (points @ queries.T >= least) & others
                    there += int((linked * some.column("n").to_numpy()[:, None]).sum())
        yield pa.record_batch([pa.array([there])], names=["there"])

    there = nodes.select("node", "vec", "n").mapInArrow(count, "there bigint").agg(F.sum("there")).first()[0] or 0
    names = nodes.sparkSession.createDataFrame([(int(name),) for name in asked["node"]], "node bigint")
    had = found.join(F.broadcast(names), "node", "left_semi").agg(F.sum("links")).first()[0] or 0
    return had, there


def link_vectors(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE, shard_rows: int = SHARD_ROWS,
    rows_per_shard: int = ROWS_PER_SHARD, audit_rows: int = AUDIT_ROWS,
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept."""
    rows = as_doubles(vectors, key, vector)
    good = usable(F.col("vec")) & F.col("id").isNotNull()
    nodes = stored(rows.where(good).groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    total = nodes.count()
    sample = nodes.orderBy(F.xxhash64("node"), "node").select("vec").limit(SAMPLE_ROWS).toPandas()
    lengths = sorted({len(v) for v in sample["vec"]})
    shards = max(1, min(MOST_SHARDS, -(-total // rows_per_shard)))
    # Vectors of each length have centres of their own; a length not in the sample is one shard.
    centres = {}
    for length in lengths:
        points = _unit(np.stack([v for v in sample["vec"] if len(v) == length]))
        centres[length] = fit_centres(points, max(1, min(len(points), shards)))
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def search_all(each: int, overlap: float) -> DataFrame:
        """Links and roots found by node, with so many shards for a node within ``overlap`` of its best centre."""

        @F.arrow_udf("array<bigint>")
        def shards_of(column: pa.Array) -> pa.Array:
            known, size = shared.value, pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            places: list[list[int]] = [[]] * len(column)
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                if length not in known:
                    for row in rows.tolist():
                        places[row] = [length * MOST_SHARDS]
                    continue
                points = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), length)
                for begin in range(0, len(rows), 1024):
                    sims = _unit(points[begin : begin + 1024]) @ known[length].T
                    nearest = np.argsort(-sims, axis=1, kind="stable")[:, :each]
                    best = np.take_along_axis(sims, nearest, axis=1)
                    near = best >= best[:, :1] - overlap
                    for row, some, ok in zip(rows[begin : begin + 1024].tolist(), nearest, near, strict=True):
                        places[row] = (length * MOST_SHARDS + np.sort(some[ok])).tolist()
            return pa.array(places, pa.list_(pa.int64()))

        assigned = stored(nodes.withColumn("shards", shards_of(F.col("vec"))), "assigned")
        placed = assigned.withColumn("shard", F.explode("shards"))
        sizes = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("parts"))
        sizes = F.broadcast(sizes)  # at most a row per centre
        placed = placed.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))

        def build(group: pd.DataFrame) -> pd.DataFrame:
            ids = group["node"].to_numpy(np.int64)
            lists = _both_ways(_links(_unit(np.stack(group["vec"].to_numpy())).astype(np.float32)))
            return pd.DataFrame({"node": ids, "near": [ids[part] for part in lists]})

        built = placed.groupBy("shard", "part").applyInPandas(build, "node bigint, near array<bigint>")
        united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        ready = placed.select("node", "vec", "n", "shards", "shard", "parts", "part").join(stored(united, "graph"), "node")
        asked = dealt(ready)

        def search(group: pd.DataFrame) -> pd.DataFrame:
            ids = group["node"].to_numpy(np.int64)
            exact = _unit(np.stack(group["vec"].to_numpy()))
            stands, asks = np.flatnonzero(group["stands"].to_numpy(bool)), np.flatnonzero(group["asks"].to_numpy(bool))
            if not len(stands) or not len(asks):
                return pd.DataFrame({"node": [], "links": [], "root": []})
            own = np.full(len(ids), -1)
            own[stands] = np.arange(len(stands))
            order = np.argsort(ids[stands])
            by_id = ids[stands][order]
            lists = []
            for near in group["near"].to_numpy()[stands]:
                at = np.searchsorted(by_id, near)
                at[at == len(by_id)] = 0
                lists.append(order[at[by_id[at] == near]])
            table = np.full((len(stands), max(1, *map(len, lists), 1)), -1)
            for k, line in enumerate(lists):
                table[k, : len(line)] = line
            quick = exact.astype(np.float32)
            weights = group["n"].to_numpy(np.int64)
            width = max(map(len, group["shards"]))
            member = np.stack([np.pad(np.asarray(s), (0, width - len(s)), constant_values=-1) for s in group["shards"]])
            links, roots = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            for query, node in _search(quick[stands], table, quick[asks], own[asks], least):
                query, node = asks[query], stands[node]
                apart = query != node
                query, node = query[apart], node[apart]
                held = np.concatenate([np.einsum("id,id->i", exact[query[a : a + 100_000]], exact[node[a : a + 100_000]]) >= least for a in range(0, len(query), 100_000)] or [np.zeros(0, bool)])
                query, node = query[held], node[held]
                # Only in the first shard that both are in.
                common = np.full(len(query), np.iinfo(np.int64).max)
                for k in range(width):
                    mine = member[query, k]
                    both = (mine >= 0) & np.any([mine == member[node, j] for j in range(width)], axis=0)
                    common = np.where(both, np.minimum(common, mine), common)
                first = common == group["shard"].iloc[0]
                links += np.bincount(query[first], weights[node[first]], len(ids)).astype(np.int64)
                roots = _forest(query, node, roots)
            told = (links > 0) | (roots != np.arange(len(ids)))
            return pd.DataFrame({"node": ids[told], "links": links[told], "root": ids[roots[told]]})

        found = asked.groupBy("shard", "cell", "block").applyInPandas(search, "node bigint, links bigint, root bigint")
        return stored(found, "found")
    # Wider until the audit is content; only vectors far from all centres, or a poor sample, come to the end.
    for each, overlap in WIDTHS:
        found = search_all(each, overlap)
        had, there = audit(nodes, found, least, audit_rows)
        recall = had / there if there else 1.0
        if recall - 1.645 * np.sqrt(recall * (1 - recall) / max(there, 1)) >= LEAST_RECALL:
            break
    else:
        warnings.warn(f"the audit found {recall:.3f} of the links of {audit_rows} vectors", stacklevel=2)
    linked = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    # The least id of a component is that of a node: each node is named by its least id.
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(counts, "node", "left").join(linked, "node", "left").select(
        "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    known = stored(known, "known")
    linking = rows.where(good).join(known, "vec").select("id", "n_links", "component_id")
    others = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    result = linking.unionAll(others)
    return result.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
