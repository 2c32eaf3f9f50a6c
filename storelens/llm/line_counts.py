"""Lines repeated over documents, found through a sharded minimal perfect hash.

A line's key is the line without white space at its ends and with A-Z lower-cased; keys of
at least ``LEAST_POINTS`` code points count.  A key that at least ``LEAST_DOCS`` documents hold loses all its lines
except in the document with the largest id that holds it.

Tasks emit 96-bit hashes of the keys of their documents.  For the index only the ids of the three largest documents of
each key and task are needed: they tell exactly whether there are three, and which is
the largest.  The hashes are dealt over shards by their first bits.  Each shard has a minimal perfect hash
of its distinct hashes (levels of bit arrays, a key moves on where it meets another) and three compact arrays in the order of that hash: fingerprints,
counts up to ``LEAST_DOCS``, and the document to keep.  The documents'
hashes then probe the arrays of their shard; shards that are asked very often are asked in several
tasks, each with its own copy of the arrays.  Only what is to be dropped goes back to the documents.

Edge cases: a null or empty text is one empty line.  A document is what has one id: repeated rows of an id are
one document and lose the same lines.  Rows without an id are no documents: they keep all lines and count for none.  Lines and texts of any length are read whole.  An empty table gives no rows.  Other columns are kept as they came.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import blocks, stored
from storelens.llm.words import mix

LEAST_POINTS = 20
LEAST_DOCS = 3
SHARD_KEYS = 50_000
ASKED_AT_ONCE = 100_000
HELD_KEYS = 1_000_000
#: Bits of a level for each key that reaches it.
ROOM = 2
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(text: bytes | None) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text, and of each its key's 12-byte hash, or None if the key is short."""
    lines = (text or b"").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(_SPACE)
        # A code point has one to four bytes; others than its first begin with the bits 10.
        size = len(key)
        if size < LEAST_POINTS or (size < 4 * LEAST_POINTS and len(key.decode()) < LEAST_POINTS):
            keys.append(None)
        else:
            keys.append(hashlib.blake2b(key.lower(), digest_size=12).digest())
    return lines, keys


_HASH = np.dtype([("hash", "<i8"), ("check", "<i4")])


def _top_docs(held: list[np.ndarray]) -> np.ndarray:
    """Of (hash, check, doc) rows the largest ``LEAST_DOCS`` different documents of each key."""
    rows = np.unique(np.concatenate(held))
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows["hash"][1:] != rows["hash"][:-1]) | (rows["check"][1:] != rows["check"][:-1])
    ends = np.append(np.flatnonzero(new)[1:], len(rows))
    left = np.repeat(ends, np.diff(np.append(np.flatnonzero(new), len(rows)))) - np.arange(len(rows))
    return rows[left <= LEAST_DOCS]


_ENTRY = np.dtype([("hash", "<i8"), ("check", "<i4"), ("doc", "<i8")])


def _batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.ascontiguousarray(rows[name])) for name in _ENTRY.names], names=list(_ENTRY.names))


def _rows(table: pa.RecordBatch | pa.Table) -> np.ndarray:
    rows = np.empty(table.num_rows, dtype=_ENTRY)
    for name in _ENTRY.names:
        rows[name] = table.column(name).to_numpy() if isinstance(table, pa.Table) else table.column(name).to_numpy(zero_copy_only=False)
    return rows


def _entries(batch: pa.RecordBatch) -> np.ndarray:
    """(hash, check, doc) of every different key of every document with an id."""
    digests, docs = [], []
    for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
        if doc is not None:
            own = {key for key in line_keys(text)[1] if key is not None}
            digests += own
            docs += [doc] * len(own)
    rows = np.empty(len(docs), dtype=_ENTRY)
    hashes = np.frombuffer(b"".join(digests), dtype=_HASH)
    rows["hash"], rows["check"], rows["doc"] = hashes["hash"], hashes["check"], docs
    return rows


def asked_keys(docs: DataFrame) -> DataFrame:
    """Rows (hash, check, doc) of every different key of every document; ``docs`` has id and text."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                yield _batch(_entries(block))

    return docs.mapInArrow(ask, "hash bigint, check int, doc bigint")


def held_keys(asked: DataFrame) -> DataFrame:
    """The rows the index needs: in each task at most ``LEAST_DOCS`` documents a key, or some more after many keys."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            held.append(_rows(batch))
            size += len(held[-1])
            if size > HELD_KEYS:
                held = [_top_docs(held)]
                size = len(held[0])
                if size > HELD_KEYS // 2:
                    yield _batch(held[0])
                    held, size = [], 0
        if held:
            yield _batch(_top_docs(held))

    return asked.mapInArrow(hold, "hash bigint, check int, doc bigint")


class PerfectHash:
    """A bijection of n different keys (hash, check) and the numbers below n."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *[int(level.sum()) for level in levels]])
        self.ranks = [np.cumsum(level, dtype=np.int64) - level for level in levels]

    @staticmethod
    def _place(hashes: np.ndarray, checks: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
        mixed = mix(mix(hashes.view(np.uint64) + seed) ^ (checks.astype(np.int64).view(np.uint64) * seed))
        return (mixed % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, hashes: np.ndarray, checks: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(hashes):
            size = max(64, ROOM * len(hashes))
            at = cls._place(hashes, checks, len(levels), size)
            levels.append(np.bincount(at, minlength=size) == 1)
            moved = ~levels[-1][at]
            hashes, checks = hashes[moved], checks[moved]
        return cls(levels)

    def __call__(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each key; -1, or any number, for one that is none of the n."""
        numbers = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for k, level in enumerate(self.levels):
            at = self._place(hashes[left], checks[left], k, len(level))
            hit = level[at]
            numbers[left[hit]] = self.before[k] + self.ranks[k][at[hit]]
            left = left[~hit]
        return numbers

    def dump(self) -> tuple[list[int], list[bytes]]:
        return [len(level) for level in self.levels], [np.packbits(level).tobytes() for level in self.levels]

    @classmethod
    def load(cls, sizes: list[int], bits: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for n, b in zip(sizes, bits, strict=True)])


_ARRAYS = "shard bigint, sizes array<bigint>, bits array<binary>, fingerprints binary, counts binary, keepers binary"


def index_shards(held: DataFrame, shard_bits: int) -> DataFrame:
    """One row per shard: its perfect hash, and in its order fingerprints, counts up to ``LEAST_DOCS`` and documents to keep."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        rows = _top_docs([_rows(group)])
        first = np.flatnonzero(np.concatenate([[True], (rows["hash"][1:] != rows["hash"][:-1]) | (rows["check"][1:] != rows["check"][:-1])]))
        hashes, checks = np.ascontiguousarray(rows["hash"][first]), np.ascontiguousarray(rows["check"][first])
        found = np.diff(np.append(first, len(rows)))
        keeper = rows["doc"][np.append(first[1:], len(rows)) - 1]
        perfect = PerfectHash.of(hashes, checks)
        order = perfect(hashes, checks)
        fingerprints, counts, keepers = np.empty(len(first), "<i4"), np.empty(len(first), np.uint8), np.empty(len(first), "<i8")
        fingerprints[order], counts[order], keepers[order] = checks, found, keeper
        sizes, bits = perfect.dump()
        # Keepers are needed of frequent keys only.
        arrays = [fingerprints.tobytes(), counts.tobytes(), keepers[counts >= LEAST_DOCS].tobytes()]
        return pa.table([pa.array([key[0].as_py()]), pa.array([sizes], pa.list_(pa.int64())), pa.array([bits], pa.list_(pa.binary())), *[pa.array([a], pa.binary()) for a in arrays]], names=_NAMES)

    return held.withColumn("shard", _shard(shard_bits)).groupBy("shard").applyInArrow(build, _ARRAYS)


_NAMES = [name.split()[0] for name in _ARRAYS.split(", ")]


def _shard(bits: int):
    return F.shiftrightunsigned(F.col("hash"), 64 - bits) if bits else F.lit(0).cast("long")


def probe(asked: DataFrame, index: DataFrame, shard_bits: int, asked_at_once: int = ASKED_AT_ONCE) -> DataFrame:
    """The keys (12 bytes) whose lines go, by document."""
    asked = asked.withColumn("shard", _shard(shard_bits))
    # A shard that holds a very common line is asked in several tasks.
    turns = stored(asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / asked_at_once).alias("turns")), "turns")
    dealt = asked.join(turns, "shard").withColumn("turn", F.pmod(F.xxhash64("doc"), F.col("turns")))
    copies = index.join(turns, "shard").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1))).select(*_NAMES, "turn")

    def look(mine: pa.Table, arrays: pa.Table) -> pa.Table:
        if not mine.num_rows or not arrays.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], names=["doc", "key"])
        row = arrays.to_pylist()[0]
        perfect = PerfectHash.load(row["sizes"], row["bits"])
        fingerprints, counts = np.frombuffer(row["fingerprints"], "<i4"), np.frombuffer(row["counts"], np.uint8)
        frequent = counts >= LEAST_DOCS
        keepers, rank = np.frombuffer(row["keepers"], "<i8"), np.cumsum(frequent) - 1
        rows = _rows(mine)
        hashes, checks, docs = (np.ascontiguousarray(rows[name]) for name in _ENTRY.names)
        number = perfect(hashes, checks)
        known = (number >= 0) & (fingerprints[number] == checks) & frequent[number]
        goes = np.flatnonzero(known)
        goes = goes[docs[goes] != keepers[rank[number[goes]]]]
        digests = np.empty(len(goes), dtype=_HASH)
        digests["hash"], digests["check"] = hashes[goes], checks[goes]
        keys = pa.Array.from_buffers(pa.binary(_HASH.itemsize), len(goes), [None, pa.py_buffer(digests.tobytes())]).cast(pa.binary())
        return pa.table([pa.array(docs[goes]), keys], names=["doc", "key"])

    return dealt.groupBy("shard", "turn").cogroup(copies.groupBy("shard", "turn")).applyInArrow(look, "doc bigint, key binary")


def drop_repeated_lines(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shard_keys: int = SHARD_KEYS, asked_at_once: int = ASKED_AT_ONCE
) -> DataFrame:
    """``row`` (all columns as they came), ``kept_text``, ``n_lines`` (before) and ``n_dropped``."""
    read = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"), F.struct("*").alias("row"))
    asked = stored(asked_keys(read.select("id", "text")), "asked")
    shard_bits = max(0, (asked.count() // shard_keys).bit_length())
    index = stored(index_shards(held_keys(asked), shard_bits), "lines")
    # As many keys as a document has lines at most.
    gone = probe(asked, index, shard_bits, asked_at_once).groupBy(F.col("doc").alias("id")).agg(F.collect_set("key").alias("gone"))

    @F.arrow_udf("struct<kept_text:string,n_lines:bigint,n_dropped:bigint>")
    def without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        kept, before, less = [], [], []
        for value, keys in zip(texts.cast(pa.large_binary()).to_pylist(), dropped.to_pylist(), strict=True):
            lines, own = line_keys(value)
            goes = set(keys or ())
            stay = [line for line, k in zip(lines, own, strict=True) if k is None or k not in goes] if goes else lines
            kept.append(b"\n".join(stay).decode())
            before.append(len(lines))
            less.append(len(lines) - len(stay))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(less, pa.int64())], names=["kept_text", "n_lines", "n_dropped"])

    joined = read.join(gone, "id", "left").select("row", "id", without("text", "gone").alias("out"))
    return joined.select("row", "out.*")
