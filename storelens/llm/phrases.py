"""Phrases of two and three words that occur together more often than their parts suggest, by language.

A suffix is a word and the up to two words after it in its piece.  Every task sorts
the suffixes of a block, merges equal ones and routes them by a hash of their leading
word; words that lead a large share of all suffixes are routed by two leading
words, and pairs that lead such a share by all three.  These shares are estimated on a sample of about
``SAMPLE_ROWS`` documents; there can be no more than ``HOT_PER_PART * parts`` such words and
pairs, at most ``HOT_PER_PART * MOST_PARTS``, which bounds what is sent to all tasks.  The layout is all that depends on
it.  In each part pointers to the suffixes are sorted by a multikey three-way quicksort
down to the third word: the weight of an equal partition is the count of its words, and partitions
that weigh less than the least count are abandoned, as nothing in them can reach it.
The quicksort works on all partitions of a round at once.

A word's id is a 64-bit hash of its language and its bytes; two words share one with a
probability of about 2**-64, which is accepted.

Edge cases: null, empty and blank texts have no words; a null language is ``und``; a text or a word of any length
is read whole; repeated rows count as often as they occur; an empty table gives no rows.
Other columns of the documents are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.llm import words as W
from storelens.llm.common import stored

LEAST = 10
SWALLOWED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
DEPTH = 3

BLOCK_BYTES = 2 * 1024 * 1024
#: Places of 21 bits make one sortable key of a suffix, so a slice has fewer words than that.
PLACE = 21
SLICE_WORDS = (1 << PLACE) - 8
LONG_WORD = 1 << 16
PART_BYTES = 2 * 1024 * 1024
MOST_PARTS = 1 << 20
HOT_PER_PART = 4
SAMPLE_ROWS = 20_000
RANK_SALTS = 64
PARTS_AT_ONCE = 64

_ENDS_PIECE = np.zeros(256, dtype=bool)
_ENDS_PIECE[np.frombuffer(b".,;:!?\x0a\x0b\x0c\x0d", dtype=np.uint8)] = True
_BETWEEN = _ENDS_PIECE.copy()
_BETWEEN[[0x20, 0x09]] = True
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _short(data: bytes) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(data, digest_size=8).digest(), dtype="<u8")[0]


class Words:
    """The words of some texts in order: hash, text, piece, and their place in the bytes."""

    def __init__(self, texts: pa.Array):
        self.data, offsets = W.text_bytes(texts)
        size = len(self.data)
        kind = np.int32 if size < 2**31 else np.int64
        breaks = np.zeros(size + 1, dtype=bool)
        breaks[offsets] = True
        between = _BETWEEN[self.data]
        edges = ~between
        if size:
            edges[1:] &= between[:-1] | breaks[1:-1]
        self.begin = np.flatnonzero(edges).astype(kind)
        edges = ~between
        if size:
            edges[:-1] &= between[1:] | breaks[1:-1]
        self.end = np.flatnonzero(edges).astype(kind) + kind(1)
        del breaks, between, edges
        self.text = (np.searchsorted(offsets, self.begin, side="right") - 1).astype(np.int32)
        # A piece ends at a sign that ends pieces and at the end of its text.
        signs = np.flatnonzero(_ENDS_PIECE[self.data])
        self.piece = np.searchsorted(signs, self.begin).astype(kind) + self.text
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        hashes = np.empty(len(self.begin), dtype=np.uint64)
        long = np.flatnonzero(self.end - self.begin > LONG_WORD)
        for k in long.tolist():
            hashes[k] = _short(self.data[self.begin[k] : self.end[k]].tobytes().translate(_LOWER))
        done = 0
        for stop in [*long.tolist(), len(self.begin)]:
            while done < stop:
                low = self.begin[done]
                upto = min(int(np.searchsorted(self.end, low + W.WINDOW, side="right")), stop)
                high = self.end[upto - 1]
                sums = np.zeros(high - low + 1, dtype=np.uint64)
                np.cumsum(W._BYTE_VALUES[self.data[low:high]] * W._power("up", W._BASE, high - low), out=sums[1:])
                b, e = self.begin[done:upto] - low, self.end[done:upto] - low
                hashes[done:upto] = W.mix((sums[e] - sums[b]) * W._power("down", W._BASE_INVERSE, high - low)[b] + (e - b).astype(np.uint64))
                done = upto
            done = stop + 1
        return hashes

    def word(self, k: int) -> str:
        return self.data[self.begin[k] : self.end[k]].tobytes().translate(_LOWER).decode()


def _ids(words: Words, langs: list[str]) -> np.ndarray:
    """The id of each word in the language of its text, never 0."""
    known = {lang: _short(lang.encode()) for lang in set(langs)}
    own = np.array([known[lang] for lang in langs], dtype=np.uint64)
    ids = W.mix(words.hash + own[words.text]) if len(words.hash) else words.hash
    return np.where(ids == 0, np.uint64(1), ids)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Texts and languages in blocks of about ``BLOCK_BYTES``, or one longer text."""
    texts: list[pa.Array] = []
    langs: list[str] = []
    held = 0
    for batch in batches:
        column, names = batch.column("text"), batch.column("lang").to_pylist()
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < len(names):
            before = int(sizes[row - 1]) if row else 0
            upto = max(row + 1, int(np.searchsorted(sizes, before + BLOCK_BYTES - held, side="right")))
            texts.append(column.slice(row, upto - row).cast(pa.large_binary()))
            langs += names[row:upto]
            held += int(sizes[upto - 1]) - before
            row = upto
            if held >= BLOCK_BYTES * 3 // 4:
                yield pa.concat_arrays(texts), langs
                texts, langs, held = [], [], 0
    if texts:
        yield pa.concat_arrays(texts), langs


def _slices(texts: pa.Array, langs: list[str]) -> Iterator[tuple[Words, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of words: all words, where the slice begins, the known ids, the places of its words, and its merged suffixes with their counts.

    A suffix is three places of ``PLACE`` bits; a place is one more than the rank of the id, 0 where the piece has ended.
    """
    words = Words(texts)
    ids = _ids(words, langs)
    for begin in range(0, len(ids), SLICE_WORDS):
        end = min(begin + SLICE_WORDS, len(ids))
        upto = min(end + DEPTH - 1, len(ids))
        known, places = np.unique(ids[begin:upto], return_inverse=True)
        places = places.astype(np.int64) + 1
        keys = places[: end - begin] << (2 * PLACE)
        for step in range(1, DEPTH):
            ahead = max(0, min(end, len(ids) - step) - begin)
            same = words.piece[begin : begin + ahead] == words.piece[begin + step : begin + step + ahead]
            keys[:ahead] |= np.where(same, places[step : step + ahead], 0) << ((DEPTH - 1 - step) * PLACE)
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield words, begin, known, places[: end - begin], keys[first], np.diff(np.append(first, len(keys)))


def _columns(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Ids of the suffixes: a row for each of the three words, 0 where there is none."""
    padded = np.concatenate([np.zeros(1, np.uint64), known])
    return np.stack([padded[(keys >> (k * PLACE)) & ((1 << PLACE) - 1)] for k in range(DEPTH - 1, -1, -1)])


def _mixed(columns: np.ndarray, depth: int) -> np.ndarray:
    """One hash of the first ``depth`` ids."""
    value = W.mix(columns[0])
    for k in range(1, depth):
        value = W.mix(value * np.uint64(3) + columns[k])
    return value


def _is_in(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def hot_prefixes(docs: DataFrame, parts: int, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of the pairs that lead at least a share of ``1 / (HOT_PER_PART * parts)`` of the sample's suffixes."""
    rate = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.where(F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 20)) < int(rate * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in _texts(batches):
            for _, _, known, _, keys, n in _slices(texts, langs):
                columns = _columns(known, keys)
                for depth in range(1, DEPTH):
                    hashes, at = np.unique(_mixed(columns, depth), return_inverse=True)
                    # What is rare in a slice of this size is left out.
                    sums = np.bincount(at, n, len(hashes)).astype(np.int64)
                    kept = sums * (2 * HOT_PER_PART * parts) >= n.sum()
                    yield pa.record_batch(
                        [pa.array(np.full(kept.sum(), depth)), pa.array(hashes[kept].view(np.int64)), pa.array(sums[kept])], names=["depth", "prefix", "n"]
                    )
                yield pa.record_batch([pa.array([0]), pa.array([0]), pa.array([int(n.sum())])], names=["depth", "prefix", "n"])

    counted = stored(sample.mapInArrow(count, "depth bigint, prefix bigint, n bigint").groupBy("depth", "prefix").agg(F.sum("n").alias("n")), "prefixes")
    total = counted.where("depth = 0").agg(F.sum("n")).first()[0] or 0
    hot = counted.where((F.col("depth") > 0) & (F.col("n") * (HOT_PER_PART * parts) >= total)).toPandas()
    return tuple(np.sort(hot.loc[hot["depth"] == depth, "prefix"].to_numpy(np.int64).view(np.uint64)) for depth in (1, 2))


def route(docs: DataFrame, parts: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Merged suffixes (packed: ids and counts) and words of every block, by part."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_words, hot_pairs = shared.value
        for texts, langs in _texts(batches):
            for words, begin, known, places, keys, n in _slices(texts, langs):
                columns = _columns(known, keys)
                target = _mixed(columns, 1)
                by_two = np.flatnonzero(_is_in(target, hot_words))
                two = _mixed(columns[:, by_two], 2)
                target[by_two] = two
                by_three = by_two[_is_in(two, hot_pairs)]
                target[by_three] = _mixed(columns[:, by_three], 3)
                order, bounds = _dealt(target, parts)
                # The slice's own words, each with its count and its first place.
                counts = np.bincount(places, minlength=len(known) + 1)[1:]
                first = np.zeros(len(known), dtype=np.int64)
                first[places[::-1] - 1] = np.arange(begin, begin + len(places))[::-1]
                own = np.flatnonzero(counts)
                by_home, homes = _dealt(W.mix(known[own]), parts)
                by_home = own[by_home]
                for low in range(0, parts, PARTS_AT_ONCE):
                    high = min(low + PARTS_AT_ONCE, parts)
                    filled = low + np.flatnonzero((np.diff(bounds[low : high + 1]) > 0) | (np.diff(homes[low : high + 1]) > 0))
                    if not len(filled):
                        continue
                    some = [order[bounds[k] : bounds[k + 1]] for k in filled]
                    mine = by_home[homes[low] : homes[high]]
                    at = first[mine]
                    entries = pa.StructArray.from_arrays(
                        [
                            pa.array(known[mine].view(np.int64)), pa.array(counts[mine]),
                            pa.array([langs[t] for t in words.text[at].tolist()], pa.string()), pa.array([words.word(p) for p in at.tolist()], pa.string()),
                        ],
                        names=["id", "n", "lang", "word"],
                    )
                    lists = pa.ListArray.from_arrays(pa.array(np.append(homes[filled], homes[high]) - homes[low], pa.int32()), entries)
                    yield pa.record_batch(
                        [
                            pa.array(filled), pa.array([columns[:, x].tobytes() for x in some], pa.binary()),
                            pa.array([n[x].astype("<u4").tobytes() for x in some], pa.binary()), lists,
                        ],
                        names=["part", "grams", "counts", "words"],
                    )

    return docs.mapInArrow(routed, "part bigint, grams binary, counts binary, words array<struct<id:bigint,n:bigint,lang:string,word:string>>")


def _dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by part, and where each part begins in it (parts + 1)."""
    part = (hashes % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _active(pointers: np.ndarray, start: np.ndarray, end: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pointers of some partitions, the partition of each, where each partition begins among them, and their places."""
    length = end - start
    base = np.cumsum(length, dtype=kind) - length
    segment = np.repeat(np.arange(len(start), dtype=kind), length)
    at = np.arange(len(segment), dtype=kind) + (start - base)[segment]
    return pointers[at], segment, base, at


def quicksort_counts(columns: np.ndarray, weights: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth, pointers to one suffix of every prefix of that many words that weighs ``least``, and the weights.

    ``columns`` has a row for each word of the suffixes, 0 where a suffix has ended.
    """
    depths, size = columns.shape
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not size:
        return [none] * depths
    flat = columns.reshape(-1)
    # Four-byte places where they suffice, since several arrays of them are held at once.
    kind = np.int32 if depths * size < 2**31 else np.int64
    pointers = np.arange(size, dtype=kind)
    start, end, depth = np.array([0], kind), np.array([size], kind), np.array([0], kind)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(depths)]
    turn = 0
    while len(start):
        own, segment, base, at = _active(pointers, start, end, kind)
        # Partitions that weigh too little are abandoned, and so are empty ones before they come here.
        heavy = np.add.reduceat(weights[own], base) >= least
        if not heavy.all():
            start, end, depth = start[heavy], end[heavy], depth[heavy]
            if not len(start):
                break
            own, segment, base, at = _active(pointers, start, end, kind)
        turn += 1
        length = end - start
        chosen = base + (W.mix(start.astype(np.uint64) * np.uint64(2) + np.uint64(turn)) % length.astype(np.uint64)).astype(kind)
        value = flat[depth[segment] * kind(size) + own]
        pivot = value[chosen]
        mine = pivot[segment]
        side = np.where(value < mine, np.int8(0), np.where(value == mine, np.int8(1), np.int8(2)))
        del value, mine
        sizes = np.stack([np.bincount(segment[side == k], minlength=len(start)) for k in range(3)], axis=1).astype(kind)
        heads = start[:, None] + np.cumsum(sizes, axis=1, dtype=kind) - sizes
        moved = np.empty_like(own)
        for k in range(3):
            member = np.flatnonzero(side == k).astype(kind)
            into = segment[member]
            before = np.cumsum(sizes[:, k], dtype=kind) - sizes[:, k]
            # Places among the active ones: partitions keep their place, the three sides follow each other.
            moved[(heads[:, k] - start + base)[into] + np.arange(len(member), dtype=kind) - before[into]] = own[member]
        pointers[at] = moved
        # The equal partition's weight is the count of its words.
        same = side == 1
        equal = np.bincount(segment[same], weights[own[same]], len(start)).astype(np.int64)
        told = (pivot != 0) & (equal >= least)
        for d in range(depths):
            here = np.flatnonzero(told & (depth == d))
            if len(here):
                found[d].append((own[chosen[here]].astype(np.int64), equal[here]))
        deeper = told & (depth + 1 < depths)
        parts = [(heads[:, 0], sizes[:, 0], depth, sizes[:, 0] > 0), (heads[:, 1], sizes[:, 1], depth + kind(1), deeper), (heads[:, 2], sizes[:, 2], depth, sizes[:, 2] > 0)]
        start = np.concatenate([h[ok] for h, _, _, ok in parts])
        end = start + np.concatenate([s[ok] for _, s, _, ok in parts])
        depth = np.concatenate([d[ok] for _, _, d, ok in parts])
    return [tuple(np.concatenate(x) for x in zip(*some, strict=True)) if some else none for some in found]


def frequent_grams(docs: DataFrame, least: int = LEAST, parts: int | None = None) -> DataFrame:
    """Counts of all words, pairs and triples that occur ``least`` times, and of all words by language.

    Columns: ``depth`` (0: all words of ``lang``), ids ``w1`` to ``w3`` (0 where there is none), ``n``, and for single words ``lang`` and ``word``.
    """
    if parts is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        parts = int(min(MOST_PARTS, max(1, -(-size // PART_BYTES))))
    hot = hot_prefixes(docs, parts)
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def count(group: pa.Table) -> pa.Table:
        columns = np.concatenate([np.frombuffer(x.as_buffer(), "<u8").reshape(DEPTH, -1) for x in group.column("grams")], axis=1)
        weights = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in group.column("counts")]).astype(np.int64)
        out: list[pa.Table] = []

        def tell(depth: int, ids: np.ndarray, n: np.ndarray, lang: pa.Array | None = None, word: pa.Array | None = None) -> None:
            none = pa.nulls(len(n), pa.string())
            named = [pa.array(ids[k].view(np.int64)) if k < len(ids) else pa.array(np.zeros(len(n), np.int64)) for k in range(DEPTH)]
            out.append(pa.table([pa.array(np.full(len(n), depth)), *named, pa.array(n), none if lang is None else lang, none if word is None else word], names=_GRAM_NAMES))

        # Pairs dealt by all three words have a share here and others elsewhere.
        split = np.flatnonzero(_is_in(_mixed(columns, 2), shared.value[1]) & (columns[1] != 0))
        pairs, at = np.unique(columns[:2, split], axis=1, return_inverse=True)
        tell(2, pairs, np.bincount(at.reshape(-1), weights[split], pairs.shape[1]).astype(np.int64))
        for depth, (pointers, n) in enumerate(quicksort_counts(columns, weights, least), start=1):
            if depth == 2:
                whole = ~_is_in(_mixed(columns[:, pointers], 2), shared.value[1])
                pointers, n = pointers[whole], n[whole]
            if depth > 1:
                tell(depth, columns[:depth, pointers], n)
        # Single words have their counts with them, as those dealt by two words lie in many parts.
        entries = pa.concat_arrays([chunk.flatten() for chunk in group.column("words").chunks])
        ids, at = np.unique(entries.field("id").to_numpy(zero_copy_only=False), return_inverse=True)
        counts = np.bincount(at, entries.field("n").to_numpy(zero_copy_only=False), len(ids)).astype(np.int64)
        _, first = np.unique(at, return_index=True)
        lang = entries.field("lang").take(pa.array(first))
        word = entries.field("word").take(pa.array(first))
        kept = counts >= least
        tell(1, ids[None, kept], counts[kept], lang.filter(pa.array(kept)), word.filter(pa.array(kept)))
        sums = pa.table([lang, pa.array(counts)], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
        tell(0, np.zeros((0, sums.num_rows), np.int64), sums.column("n_sum").to_numpy().astype(np.int64), sums.column("lang"))
        return pa.concat_tables(out)

    counted = route(docs, parts, hot).groupBy("part").applyInArrow(count, _GRAM_SCHEMA)
    merged = counted.groupBy("depth", "w1", "w2", "w3", F.when(F.col("depth") < 2, F.col("lang")).alias("lang")).agg(F.sum("n").alias("n"), F.max("word").alias("word"))
    return merged.where((F.col("depth") == 0) | (F.col("n") >= least))


_GRAM_NAMES = ["depth", "w1", "w2", "w3", "n", "lang", "word"]
_GRAM_SCHEMA = "depth bigint, w1 bigint, w2 bigint, w3 bigint, n bigint, lang string, word string"


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts below 10**15."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(SCALE).cast("decimal(7,0)"), left * right)


def collocations(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", least: int = LEAST, swallowed: int = SWALLOWED_PERCENT,
    top: int = TOP, parts: int | None = None,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Dropped are phrases inside a longer candidate that has at least ``swallowed`` per cent of their count.
    """
    read = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    grams = stored(frequent_grams(read, least, parts), "grams")
    words = grams.where("depth = 1").select(F.col("w1").alias("w"), "lang", "word", F.col("n").alias("f"))
    pairs = grams.where("depth = 2").select("w1", "w2", F.col("n").alias("a"))
    triples = grams.where("depth = 3").select("w1", "w2", "w3", F.col("n").alias("a"))

    def with_word(df: DataFrame, k: int) -> DataFrame:
        named = words.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))
        return df.join(named, f"w{k}")

    inside = triples.select("w1", "w2", "a").unionAll(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = inside.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    twos = pairs.join(longer, ["w1", "w2"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * swallowed))
    twos = with_word(with_word(twos, 1), 2).select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), cut_score(F.col("a"), F.col("f1"), F.col("f2")).alias("score")
    )
    threes = triples.join(pairs.select("w1", "w2", F.col("a").alias("f12")), ["w1", "w2"])
    threes = threes.join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
    threes = with_word(with_word(with_word(threes, 1), 2), 3).withColumns(
        {"one": cut_score(F.col("a"), F.col("f1"), F.col("f23")), "two": cut_score(F.col("a"), F.col("f12"), F.col("f3"))}
    )
    early = F.col("one") <= F.col("two")
    threes = threes.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("one", "two").alias("score"),
    )
    # The first ones of every salt, then of the language: no task orders all phrases of a language.
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    found = twos.unionAll(threes).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    totals = grams.where("depth = 0").select("lang", "n")
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
