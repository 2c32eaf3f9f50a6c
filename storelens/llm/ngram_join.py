"""Jaccard self-join of documents on word shingles, with components of linked documents.

Two documents link if the intersection of their shingle sets is at least 75 per
cent of the union.  The tokens (64-bit hashes of shingles) are ordered from rare to
frequent.  Of two linked sets each one's first ``|x| - ceil(0.75 |x|) + k`` tokens,
the prefix extended to k, share at least k tokens.  With k = 2 such a pair shares
a rare token or at least two frequent ones, so rare tokens are indexed one by one
and frequent tokens in combinations of two; both only within extended prefixes.

Most of the work is spared by classes.  Equal sets are one class from the
start.  Every document is compared with the first one of those that share two of
its ``SEEDS`` least tokens, and what links is joined.  The index then only
compares documents of different classes; frequent tokens that one class has
for itself need no combination.  Candidate pairs that may
link by their sketches are verified on the whole sets.  Documents that share two frequent
tokens meet with their sketches, so that only pairs that may link become rows.

Which tokens are frequent only steers the work, never the result: those of at
least ``FREQUENT`` sets, by counts of all tokens, the
``MOST_FREQUENT`` most frequent of them, which bounds what is broadcast.

Edge cases: a text without words (null, empty, white space) has an empty set and
links with nothing; one with fewer than five words has one shingle.  Repeated
rows, of one key or of many, have equal sets and share a component.  A row with
a null key links like others but names no component, unless it is alone in it, where the component is null.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import blocks, checked_join, discard, shuffles_removed, stored
from storelens.llm.components import components
from storelens.llm.words import shingle_sets

PERCENT = 75
SEEDS = 4
FREQUENT = 16
MOST_FREQUENT = 1 << 18
EXTEND = 2
POSTINGS_PER_BUCKET = 400_000
COUNTED_PER_PART = 1_000_000
COMBINATIONS_PER_BUCKET = 200_000
MEETING_ROWS = 4_000
LEAST_BITS, MOST_BITS = 64, 8192


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for block in blocks(batch, "text"):
            yield block, shingle_sets(block.column("text"))


def _prefix_size(n: int, percent: int) -> int:
    """Tokens of the prefix extended to ``EXTEND`` of a set of n."""
    return n - -(-percent * n // 100) + EXTEND


def summaries(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (id, text): id, n, two hashes of the set, its least tokens, its sketch.

    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, sets in _sets(batches):
            place = np.arange(1, max(map(len, sets), default=0) + 1, dtype=np.uint64)
            first = [int((s ^ (s >> np.uint64(7))).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            second = [int((s * place[: len(s)]).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            yield pa.record_batch(
                [
                    block.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()), pa.array([s[:SEEDS].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([_sketch(s) for s in sets], pa.binary()),
                ],
                names=["id", "n", "set_a", "set_b", "seeds", "sketch"],
            )

    return docs.mapInArrow(summarise, "id bigint, n bigint, set_a bigint, set_b bigint, seeds array<bigint>, sketch binary")


def _part_bits(total: int) -> int:
    """Bits that number the parts in which ``total`` tokens are counted."""
    return min((total // COUNTED_PER_PART).bit_length(), 31)


def frequent_tokens(docs: DataFrame, bits: int, least: int = FREQUENT, most: int = MOST_FREQUENT) -> DataFrame:
    """The most frequent tokens of at least ``least`` sets, by their first 32 + ``bits`` bits, and their counts.

    Tasks send the tokens of all sets, 32 bits of each, to 2 ** ``bits`` parts of the hash range, which count them.
    """

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def packed() -> pa.RecordBatch:
            begun = np.sort(np.concatenate(held)) >> np.uint64(32 - bits)
            part = (begun >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            small = begun.astype("<u4")
            blobs = [small[a:b].tobytes() for a, b in zip(cuts.tolist(), np.append(cuts, len(part))[1:].tolist(), strict=True)]
            return pa.record_batch([pa.array(part[cuts]), pa.array(blobs, pa.binary())], names=["part", "tokens"])

        for _, sets in _sets(batches):
            held += sets
            size += sum(map(len, sets))
            if size > 2_000_000:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    def counted(packed: pa.Table) -> pa.Table:
        part = np.uint64(packed["part"][0].as_py())
        tokens, counts = np.unique(np.frombuffer(b"".join(packed["tokens"].to_pylist()), dtype="<u4"), return_counts=True)
        kept = counts >= least
        whole = (part << np.uint64(32)) | tokens[kept].astype(np.uint64)
        return pa.table({"token": whole.view(np.int64), "n": counts[kept].astype(np.int64)})

    counts = docs.mapInArrow(dealt, "part bigint, tokens binary").groupBy("part").applyInArrow(counted, "token bigint, n bigint")
    return counts.orderBy(F.desc("n"), "token").limit(most)


def _token_ranks(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MOST_FREQUENT`` tokens, sorted, and their ranks from rare to frequent."""
    rows = frequent.toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    tokens, counts = tokens[order], rows["n"].to_numpy(np.int64)[order]
    ranks = np.empty(len(tokens), dtype=np.int64)
    ranks[np.lexsort((tokens, counts))] = np.arange(len(tokens))
    return tokens, ranks


def postings(docs: DataFrame, frequent: DataFrame, bits: int, buckets: int, percent: int = PERCENT) -> DataFrame:
    """Index entries of ``docs`` (id, class, text): packed rare tokens by bucket, and each document's frequent ones.

    Of a rare token the bucket keeps 32 bits and the number of its document within the block;
    tokens that agree by chance only give a candidate more, which is verified.
    """
    tokens, ranks = _token_ranks(frequent)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokens, ranks))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for block, sets in _sets(batches):
            ids = block.column("id").to_numpy(zero_copy_only=False)
            classes = block.column("class").to_numpy(zero_copy_only=False)
            rare, rows, lists = [], [], []
            for row, s in enumerate(sets):
                size = min(_prefix_size(len(s), percent), len(s))
                begun = s >> np.uint64(32 - bits)
                at = np.searchsorted(known, begun)
                at[at == len(known)] = 0
                common = known[at] == begun if len(known) else np.zeros(len(s), dtype=bool)
                alone = s[~common][:size]
                rare.append(alone)
                rows.append(np.full(len(alone), row))
                left = size - len(alone)
                # Tokens that begin alike have one rank and stay in their order.
                by_rank = np.argsort(rank[at[common]], kind="stable")[:left]
                lists.append(s[common][by_rank].view(np.int64) if left else np.zeros(0, np.int64))
            token, row = np.concatenate(rare), np.concatenate(rows)
            bucket = (token >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            token, row, bucket = token[order], row[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
            ends = np.append(cuts[1:], len(token))
            small = token.astype(np.uint32)
            sizes = np.array([len(one) for one in sets], dtype="<u4")
            packed = []
            for a, b in zip(cuts.tolist(), ends.tolist(), strict=True):
                used, number = np.unique(row[a:b], return_inverse=True)
                # Most documents are a class of their own, which takes no room.
                joined = np.flatnonzero(classes[used] != ids[used])
                head = np.array([len(used), len(joined)], dtype="<u4").tobytes()
                own = [ids[used].tobytes(), classes[used[joined]].tobytes(), sizes[used].tobytes(), joined.astype("<u2").tobytes()]
                packed.append(b"".join([head, *own, small[a:b].tobytes(), number.astype("<u2").tobytes()]))
            yield pa.record_batch(
                [
                    pa.array(bucket[cuts].astype(np.int64)), pa.array(packed, pa.binary()), pa.nulls(len(cuts), pa.int64()),
                    pa.nulls(len(cuts), pa.int64()), pa.nulls(len(cuts), pa.list_(pa.int64())),
                ],
                names=["bucket", "rare", "id", "class", "frequent"],
            )
            some = [k for k, found in enumerate(lists) if len(found)]
            yield pa.record_batch(
                [
                    pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary()), pa.array(ids[some], pa.int64()),
                    pa.array(classes[some], pa.int64()), pa.array([lists[k] for k in some], pa.list_(pa.int64())),
                ],
                names=["bucket", "rare", "id", "class", "frequent"],
            )

    return docs.mapInArrow(index, "bucket bigint, rare binary, id bigint, class bigint, frequent array<bigint>")


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a block's postings, and of each its document: id, class, size."""
    documents, joined = np.frombuffer(blob, dtype="<u4", count=2).tolist()
    at = 8

    def taken(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(blob, dtype=kind, count=count, offset=at)
        at += values.nbytes
        return values

    ids, classes, sizes, places = taken("<i8", documents), taken("<i8", joined), taken("<u4", documents), taken("<u2", joined)
    table = np.stack([ids, ids, sizes.astype(np.int64)], axis=1)
    table[places, 1] = classes
    n = (len(blob) - at) // 6
    tokens, numbers = taken("<u4", n), taken("<u2", n)
    return tokens, table[numbers]


def _pairs_of_bucket(packed: pd.DataFrame, percent: int = PERCENT) -> pd.DataFrame:
    """Candidate pairs that share a rare token of a bucket, of different classes and of sizes that can link."""
    parts = [_unpacked(blob) for blob in packed["rare"]]
    token, entries = np.concatenate([t for t, _ in parts]), np.concatenate([e for _, e in parts])
    order = np.lexsort((entries[:, 1], token))
    token, (ids, classes, sizes) = token[order], entries[order].T
    begins = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
    ends = np.append(begins[1:], len(token))
    # Only tokens of two classes at least: sorted by class, the ends of a run then differ.
    mixed = classes[begins] != classes[ends - 1]
    found = []
    for a, b in zip(begins[mixed].tolist(), ends[mixed].tolist(), strict=True):
        # Each entry with the later ones, so that a long run takes no more room than a row of pairs at a time.
        for k in range(a, b - 1):
            other = slice(k + 1, b)
            fits = (classes[other] != classes[k]) & (np.minimum(sizes[other], sizes[k]) * 100 >= np.maximum(sizes[other], sizes[k]) * percent)
            if fits.any():
                y = ids[other][fits]
                found.append(np.stack([np.minimum(y, ids[k]), np.maximum(y, ids[k])]))
    if not found:
        return pd.DataFrame({"x": np.zeros(0, np.int64), "y": np.zeros(0, np.int64)})
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pd.DataFrame({"x": pairs[0], "y": pairs[1]})


def _sketch(tokens: np.ndarray) -> bytes:
    """The number of tokens, and of each part of the hash range whether it has an odd number of them; twice as many parts as tokens or more."""
    bits = min(max(1 << (2 * len(tokens) - 1).bit_length() if len(tokens) else 0, LEAST_BITS), MOST_BITS)
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return len(tokens).to_bytes(4, "little") + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches by width, to compare many at once."""

    def __init__(self, blobs: list[bytes]):
        self.widths = np.array([len(b) - 4 for b in blobs], dtype=np.int64)
        self.sizes = np.array([int.from_bytes(b[:4], "little") for b in blobs], dtype=np.int64)
        self.rows, self.at = {}, np.zeros(len(blobs), dtype=np.int64)
        for width in np.unique(self.widths).tolist():
            own = np.flatnonzero(self.widths == width)
            self.at[own] = np.arange(len(own))
            self.rows[width] = np.frombuffer(b"".join(blobs[k][4:] for k in own.tolist()), dtype="<u8").reshape(len(own), -1)

    def may_link(self, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Whether the sets of each x and y may link by their sizes, and as they differ in a token at least for each part that is odd in one only."""
        differ = np.zeros(len(x), dtype=np.int64)
        widths = np.stack([self.widths[x], self.widths[y]])
        for one, two in np.unique(widths, axis=1).T.tolist():
            own = np.flatnonzero((widths[0] == one) & (widths[1] == two))
            # A chunk at a time: so many pairs of the widest sketches are 16 MB.
            for chunk in np.array_split(own, -(-len(own) // 8192)):
                left, right = self.rows[one][self.at[x[chunk]]], self.rows[two][self.at[y[chunk]]]
                least = min(one, two) // 8
                # Parts of a wider sketch that agree in their last bits are one part of the narrower.
                left, right = (np.bitwise_xor.reduce(side.reshape(len(chunk), -1, least), axis=1) for side in (left, right))
                differ[chunk] = np.bitwise_count(left ^ right).sum(axis=1)
        total = self.sizes[x] + self.sizes[y]
        twice_both = np.minimum(total - differ, 2 * np.minimum(self.sizes[x], self.sizes[y]))
        return twice_both * (100 + percent) >= 2 * percent * total


def possible(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (x, y) that may link by their sketches (id, sketch); no pair that links is lost."""

    @F.arrow_udf("boolean")
    def may_link(left: pa.Array, right: pa.Array) -> pa.Array:
        x = np.arange(len(left))
        both = Sketches(left.to_pylist() + right.to_pylist())
        return pa.array(both.may_link(x, x + len(left), percent), pa.bool_())

    joined = pairs.join(sketches.select(F.col("id").alias("x"), F.col("sketch").alias("left")), "x")
    joined = joined.join(sketches.select(F.col("id").alias("y"), F.col("sketch").alias("right")), "y")
    return joined.where(may_link(F.col("left"), F.col("right"))).select("x", "y").distinct()


def _combinations(tokens: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A hash of each own token with each later one."""
    first = np.flatnonzero(own)
    later = len(tokens) - 1 - first
    one = np.repeat(first, later)
    two = np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later) + one + 1
    return tokens[one] * np.uint64(0x9E3779B97F4A7C15) + tokens[two]


def _pairs_of_two(buckets: int, percent: int = PERCENT):
    """Pairs of a bucket, of one part or of two, that share a combination of two of ``tokens``, the first one of the bucket, are of different classes and may link by their sketches."""

    def pairs(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        ids, classes, parts = rows["id"].to_numpy(), rows["class"].to_numpy(), rows["part"].to_numpy()
        one_part = rows["low"][0] == rows["high"][0]
        sketches = Sketches(rows["sketch"].to_pylist())
        keys, docs = [], []
        for k, tokens in enumerate(rows["tokens"]):
            tokens = tokens.values.to_numpy()
            keys.append(_combinations(tokens.view(np.uint64), tokens % buckets == bucket))
            docs.append(np.full(len(keys[-1]), k))
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        lengths = np.diff(np.append(begins, len(key)))
        mixed = np.minimum.reduceat(classes[doc], begins) != np.maximum.reduceat(classes[doc], begins)
        begins, ends = begins[mixed], (begins + lengths)[mixed]
        # The runs of each document, all of which meet it; within a run documents ascend.
        run = np.repeat(np.arange(len(begins)), ends - begins)
        met = doc[np.repeat(mixed, lengths)]
        order = np.argsort(met, kind="stable")
        run, met = run[order], met[order]
        cuts = np.flatnonzero(np.diff(met, prepend=-1))
        found = [np.zeros((2, 0), dtype=np.int64)]
        seen = np.zeros(len(ids), dtype=bool)
        for a, b in zip(cuts.tolist(), np.append(cuts, len(met))[1:].tolist(), strict=True):
            k = int(met[a])
            seen[k + 1 :] = False
            for r in run[a:b].tolist():
                seen[doc[begins[r] : ends[r]]] = True
            other = np.flatnonzero(seen[k + 1 :]) + k + 1
            other = other[(classes[other] != classes[k]) & (one_part | (parts[other] != parts[k]))]
            if len(other):
                other = other[sketches.may_link(np.full(len(other), k), other, percent)]
                found.append(np.stack([np.minimum(ids[other], ids[k]), np.maximum(ids[other], ids[k])]))
        x, y = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"x": x, "y": y})

    return pairs


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (x, y) of ids whose whole sets link; ``docs`` has id and text."""
    wanted = stored(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "wanted")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, sets in _sets(batches):
            yield pa.record_batch([block.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "tokens"])

    found = checked_join(docs, wanted, "id", "left_semi").mapInArrow(whole, "id bigint, tokens binary")
    joined = pairs.join(found.select(F.col("id").alias("x"), F.col("tokens").alias("left")), "x")
    joined = joined.join(found.select(F.col("id").alias("y"), F.col("tokens").alias("right")), "y")

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        results = []
        for a, b in zip(left, right, strict=True):
            x, y = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
            both = np.isin(x, y, assume_unique=True).sum()
            results.append(bool(100 * both >= percent * (len(x) + len(y) - both)))
        return pa.array(results, pa.bool_())

    return joined.where(linked(F.col("left"), F.col("right"))).select("x", "y")


def link_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id (smallest key reachable by links)."""
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = stored(summaries(texts), "summaries")

    # Equal sets: the smallest key stands for them.  Rows without a key go with theirs.
    filled = rows.where("n > 0")
    groups = stored(filled.where("id is not null").groupBy("set_a", "set_b", "n").agg(F.min("id").alias("id"), F.first("seeds").alias("seeds")), "groups")
    two = F.expr("filter(flatten(transform(seeds, (a, i) -> transform(seeds, (b, j) -> if(i < j, xxhash64(a, b), null)))), h -> h is not null)")
    seeds = groups.where("n > 1").select("id", F.explode(two).alias("token"))
    firsts = stored(seeds.groupBy("token").agg(F.min("id").alias("first")), "firsts")
    stars = seeds.join(firsts, "token").where("id <> first").select(F.col("first").alias("x"), F.col("id").alias("y"))
    representatives = checked_join(texts, stored(groups.select("id"), "representatives"), "id", "left_semi")
    sketches = rows.where("n > 1").select("id", "sketch")
    first_pairs = stored(possible(stars.distinct(), sketches, percent), "stars")
    near = stored(verified(first_pairs, representatives, percent), "near")
    for done in (firsts, first_pairs):
        discard(done)
    classes = components(near.select(F.col("x").alias("a"), F.col("y").alias("b")))
    ids = groups.where("n > 1").select("id")
    named = ids.join(classes.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("id", F.coalesce("component", "id").alias("class")), "classes")

    total = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(8, total // (3 * POSTINGS_PER_BUCKET))
    bits = _part_bits(total)
    frequent = stored(frequent_tokens(representatives, bits), "frequent")
    classed = checked_join(texts, named, "id", "inner")
    index = stored(postings(classed, frequent, bits, buckets, percent), "postings")
    by_rare = index.where("bucket is not null").select("bucket", "rare").groupBy("bucket").applyInPandas(lambda packed: _pairs_of_bucket(packed, percent), "x bigint, y bigint")

    # Frequent tokens that only one class has link no two classes.
    listed = index.where("frequent is not null").select("id", "class", "frequent")
    entries = listed.select("id", "class", F.explode("frequent").alias("token"))
    mixed = entries.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("token")
    mixed = stored(mixed, "mixed")
    kept = checked_join(entries, mixed, "token", "left_semi")
    lists = kept.groupBy("id", "class").agg(F.sort_array(F.collect_set("token")).alias("tokens")).where("size(tokens) > 1")
    lists = stored(lists, "lists")
    with shuffles_removed(docs.sparkSession):
        combinations = lists.agg(F.sum(F.expr("size(tokens) * (size(tokens) - 1L) div 2")).alias("n")).first()["n"] or 0
    meetings = max(16, combinations // COMBINATIONS_PER_BUCKET)
    # A document goes to the buckets of its tokens but the last, which comes first in no combination.
    into = F.explode(F.expr(f"array_distinct(transform(slice(tokens, 1, size(tokens) - 1), t -> pmod(t, {meetings}L)))")).alias("bucket")
    sizes = lists.select(into).groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / MEETING_ROWS).alias("parts"))
    # Large buckets are dealt into parts, of which every two meet in a group of their own.
    dealt = lists.select(into, "id", "class", "tokens").join(F.broadcast(stored(sizes, "sizes")), "bucket")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), "parts")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"low": F.least("part", "with"), "high": F.greatest("part", "with")}).drop("parts", "with")
    by_two = dealt.join(sketches, "id").groupBy("bucket", "low", "high").applyInArrow(_pairs_of_two(meetings, percent), "x bigint, y bigint")

    candidates = stored(by_rare.distinct(), "candidates")
    left = stored(possible(candidates, sketches, percent).unionAll(by_two).distinct(), "possible")
    for done in (index, mixed, lists, candidates):
        discard(done)
    links = verified(left, representatives, percent)
    final = components(near.unionAll(links).select(F.col("x").alias("a"), F.col("y").alias("b")))
    final = stored(final.withColumnsRenamed({"node": "id"}), "components")
    grouped = groups.join(final, "id", "left").select("set_a", "set_b", "n", F.coalesce("component", "id").alias("component_id"))
    known = stored(grouped, "grouped")
    result = checked_join(rows.drop("seeds", "sketch"), known, ["set_a", "set_b", "n"], "left")
    result = result.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    result = stored(result, "linked-documents")
    for done in (rows, groups, near, named, left, frequent, final, known):
        discard(done)
    return result


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents of which no linked one has a smaller key; all columns stay.

    Of repeated rows with equal key and text one stays; documents without words and those without a key all stay.
    """
    linked = link_documents(docs, key=key, text=text, percent=percent).where("n_shingles > 0")
    dropped = stored(linked.where(F.col(key) != F.col("component_id")).select(key).distinct(), "dropped")
    repeated = stored(linked.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key), "repeated")
    kept = checked_join(docs, dropped, key, "left_anti")
    # Only keys that come more than once are moved.
    once = checked_join(kept, repeated, key, "left_anti")
    return once.unionByName(checked_join(kept, repeated, key, "left_semi").dropDuplicates([key, text]))
