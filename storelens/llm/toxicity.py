"""Toxicity by class-conditional Kneser-Ney models of toxic and of ordinary text.

Bigrams of the labelled training texts are counted for both classes.  With n_c(vw) the count of
word w after v in class c, N_c(w) the number of distinct contexts of w there and D the discount,

    p(w)     = max(N(w) - D, 0) / N + D V / N / (V + 1)                         shared by both classes
    p_c(w)   = max(N_c(w) - D, 0) / N_c + D V_c / N_c p(w)
    p_c(w|v) = max(n_c(vw) - D, 0) / n_c(v) + D k_c(v) / n_c(v) p_c(w)

where N(w) counts the contexts in either class, V and V_c the distinct words, k_c(v) the distinct words after v,
and N, N_c, n_c(v) are sums over all words; a word in neither class has N(w) = 0, and a context that c
never has gives p_c(w).  Rare expressions thus fall back on counts that the classes share.

A text's log-likelihood in a class is a sum of three independent terms a position, each of which
a table holds by a 64-bit hash: ln p_c(w); the context's ln(D k_c(v) / n_c(v)); and for counted bigrams
ln(1 + max(n_c(vw) - D, 0) / (D k_c(v) p_c(w))).  The score is a logistic curve over the differences of the
length-normalised log-likelihoods of both orders, words and bigrams, and over two parts of the
first: the share that telling words bring, and the strongest word.  The curve is fitted
on training texts that the counts have not seen.

All words, contexts and bigrams are kept.  The terms of the ``MOST_EXPRESSIONS`` most
frequent are sent to all tasks with a filter of fixed size that names the others.  What is not sent and the filter
names is looked up: the lookups of a block of texts are packed by bucket of the hash, meet the terms
of their bucket, and the answers of all buckets are added up by block.  The filter only saves work: a wrong hit finds no term.
Counting and looking up go over the expressions in up to ``ROUNDS`` rounds, by the hash of the word or of the bigram's context, and the
files of a round go before the next, so that the disk holds one round's shuffles at a time.
The sums of all rounds are brought together by text once, after the last.  Of the probabilities of words those of the ``HOT_WORDS`` most
frequent are sent to the bigrams, and only bigrams of other words are moved to theirs.
The curve is fitted on at most ``CALIBRATION_ROWS`` labelled texts.

Edge cases: a null or empty text has no words and takes the curve's value at
zero.  Repeated rows are scored alike and count as often as they come.  Labels of null count as none.
Without labels of both classes every score is 0.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import BROADCAST_BYTES, blocks, checked_join, discard, frame_bytes, release_memory, shuffles_removed, stored
from storelens.llm.words import word_hashes

MOST_EXPRESSIONS = 1 << 19
ROUNDS = 4
ROUND_BYTES = 64 << 20
TERMS_PER_BUCKET = 500_000
HOT_WORDS = 1 << 17
FILTER_PARTS = 64
FILTER_SLOTS = 1 << 21
SLOT_BITS = 20
SCORED_BYTES = 1 << 20
DISCOUNT = 0.75
TELLING = 1.0
CALIBRATION_ROWS = 20_000
THRESHOLD = 0.3

_BEGIN = np.uint64(0x5851F42D4C957F2D)
CLASSES = ("ordinary", "toxic")
SUMS = ("words", "word_toxic", "word_ordinary", "all_toxic", "all_ordinary", "telling", "strongest")
FEATURES = ("bigram_difference", "word_difference", "telling_difference", "strongest_word")
_CONTEXT = 0x1D8E4E27C47D124F


def _bigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and context hash of every position, and each text's offset."""
    words, offsets = word_hashes(texts)
    before = np.concatenate([np.array([_BEGIN]), words])[: len(words)]
    starts = offsets[:-1]
    before[starts[starts < offsets[1:]]] = _BEGIN
    return words, before, offsets


def rounds_for(texts: DataFrame) -> int:
    """One round for each ``ROUND_BYTES`` of the column text, ``ROUNDS`` at most."""
    return min(ROUNDS, 1 + frame_bytes(texts.select("text")) // ROUND_BYTES)


def _round(hashes: np.ndarray, rounds: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(rounds)


def _round_column(name: str, rounds: int) -> Column:
    """``_round`` of a column."""
    return F.shiftrightunsigned(name, 40) % rounds


def _counts(turn: int, rounds: int):
    """Map of (text, toxic) to the counts of each (word, context) of one round by class, once per block of texts."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", SCORED_BYTES):
                words, contexts, offsets = _bigrams(block.column("text"))
                toxic = np.repeat(block.column("toxic").to_numpy(zero_copy_only=False), np.diff(offsets)).astype(np.int64)
                own = _round(contexts, rounds) == turn
                words, contexts, toxic = words[own], contexts[own], toxic[own]
                if not len(words):
                    continue
                order = np.lexsort((contexts, words))
                words, contexts, toxic = words[order], contexts[order], toxic[order]
                begins = np.flatnonzero(np.append(True, (words[1:] != words[:-1]) | (contexts[1:] != contexts[:-1])))
                times = np.diff(np.append(begins, len(words)))
                of_toxic = np.add.reduceat(toxic, begins)
                columns = [words[begins].view(np.int64), contexts[begins].view(np.int64), times - of_toxic, of_toxic]
                yield from _batches(columns, ["word", "context", "ordinary", "toxic"])

    return counts


def _batches(columns: list, names: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded length."""
    whole = pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)
    for begin in range(0, whole.num_rows, rows):
        yield whole.slice(begin, rows)


def _bigram_key(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return words ^ ((contexts << np.uint64(23)) | (contexts >> np.uint64(41)))


def _bigram_key_column() -> Column:
    """``_bigram_key`` of the columns word and context."""
    turned = F.shiftleft("context", 23).bitwiseOR(F.shiftrightunsigned("context", 41))
    return F.col("word").bitwiseXOR(turned)


@dataclass
class Terms:
    """Terms of the most frequent expressions, by sorted hash, and a filter of all others.

    ``values`` has a row of toxic and ordinary term each, a word's relative to ``base``, the logarithms of what
    words in neither class have; ``starts``, which is not sent, the place of the first hash of each beginning of ``SLOT_BITS`` bits.  The filter has a bit for the low part of each other
    expression's hash: an unset one says that the expression has no row in the table.
    """

    keys: np.ndarray
    values: np.ndarray
    others: np.ndarray
    base: np.ndarray

    def __post_init__(self):
        counts = np.bincount((self.keys >> np.uint64(64 - SLOT_BITS)).astype(np.int32), minlength=1 << SLOT_BITS)
        self.starts = np.zeros(len(counts) + 1, dtype=np.int32)
        self.starts[1:] = np.cumsum(counts, out=counts)

    def __reduce__(self):
        return Terms, (self.keys, self.values, self.others, self.base)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of each expression, 0 where none are sent, and the state: 0 unknown, 1 sent, 2 only the table can tell."""
        state, terms = np.zeros(len(keys), dtype=np.int8), np.zeros((len(keys), 2))
        # Sorted hashes are spread evenly: the first bits say where to look, and there are few to compare.
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, end = self.starts[slot], self.starts[slot + 1]
        open_ = np.flatnonzero(at < end)
        while len(open_):
            sent = self.keys[at[open_]] == keys[open_]
            state[open_[sent]] = 1
            terms[open_[sent]] = self.values[at[open_[sent]]]
            at[open_] += 1
            open_ = open_[~sent & (at[open_] < end[open_])]
        slots, bits = _filter_place(keys)
        state[(state == 0) & ((self.others[slots] >> bits) & np.uint64(1) == 1)] = 2
        return terms, state


def _filter_place(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of the filter and bit in it."""
    return (keys & np.uint64(FILTER_SLOTS - 1)).astype(np.int64), (keys >> np.uint64(32)) & np.uint64(63)


def _filter_of(keys: DataFrame) -> np.ndarray:
    """The filter that names the given keys: tasks send the places of their keys by part of the filter, and each part is put together."""
    size = FILTER_SLOTS // FILTER_PARTS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> pa.RecordBatch:
            place = np.unique(np.concatenate(held))
            cuts = np.searchsorted(place, np.arange(FILTER_PARTS + 1, dtype=np.int64) * size * 64)
            inside = (place % (size * 64)).astype("<u4")
            packed = [inside[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            return pa.record_batch([pa.array(range(FILTER_PARTS), pa.int32()), pa.array(packed, pa.binary())], names=["part", "places"])

        for batch in batches:
            slots, bits = _filter_place(batch.column(0).to_numpy().view(np.uint64))
            held.append(slots * 64 + bits.astype(np.int64))
            if sum(map(len, held)) > 1 << 18:
                yield sent()
                held = []
        if held:
            yield sent()
        release_memory()

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("places"), strict=True):
                named = np.zeros(size * 64, dtype=bool)
                named[np.frombuffer(blob.as_buffer(), dtype="<u4")] = True
                bits = np.packbits(named, bitorder="little").view("<u8")
                made[part] = made[part] | bits if part in made else bits
        yield pa.record_batch([pa.array(list(made), pa.int32()), pa.array([one.tobytes() for one in made.values()], pa.binary())], names=["part", "places"])
        made.clear()
        release_memory()

    schema = "part int, places binary"
    rows = keys.mapInArrow(places, schema).repartition("part").mapInArrow(together, schema).toArrow()
    whole = np.zeros(FILTER_SLOTS, dtype=np.uint64)
    for part, blob in zip(rows["part"].to_pylist(), rows["places"].to_pylist(), strict=True):
        whole[part * size : (part + 1) * size] = np.frombuffer(blob, dtype="<u8")
    return whole


def _keys(words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table keys of each position: its word, its context, both."""
    return words, contexts ^ np.uint64(_CONTEXT), _bigram_key(words, contexts)


@dataclass
class Model:
    """All terms (key, toxic, ordinary, word) as a frame, the most frequent ones sent to all tasks; ``base`` as in ``Terms``.

    ``rounds`` has the terms of each round that are not sent, ``buckets`` into how many parts one is dealt,
    ``counts`` the stored counts that each round, and no later one, reads.
    """

    table: DataFrame
    shared: Broadcast
    base: dict[str, float]
    rounds: list[DataFrame]
    buckets: int
    counts: list[list[DataFrame]]


def _least_count(sizes: list[tuple[int, int]], most: int) -> tuple[int | None, int]:
    """The least count with which at most ``most`` rows have it or more, from (count, rows), and their number."""
    sent, least = 0, None
    for n, found in sorted(sizes, reverse=True):
        if sent + found > most:
            break
        sent, least = sent + found, n
    return least, sent


def count_pairs(training: DataFrame, rounds: int) -> list[DataFrame]:
    """All bigrams of the training texts (text, toxic) with their counts by class, stored round by round."""
    made = []
    for turn in range(rounds):
        counted = training.mapInArrow(_counts(turn, rounds), "word bigint, context bigint, ordinary bigint, toxic bigint")
        made.append(stored(counted.groupBy("word", "context").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")), "pairs"))
    return made


def fit_model(training: DataFrame, *, most: int = MOST_EXPRESSIONS, rounds: int | None = None) -> Model:
    """Count the training texts (text, toxic) and work out the terms of every word, context and bigram.

    ``rounds`` only steers the work; by default it follows from the size of the training texts.
    """
    spark = training.sparkSession
    rounds = rounds or rounds_for(training)
    pairs = count_pairs(training, rounds)
    met = [F.count_if(F.col(c) > 0).alias(c) for c in CLASSES]
    words = stored(reduce(DataFrame.unionAll, pairs).groupBy("word").agg(*met, F.count(F.lit(1)).alias("both")), "words")
    followers = [F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in CLASSES]
    # All bigrams of a context are in its round.
    contexts = [stored(part.groupBy("context").agg(*[F.sum(c).alias(f"{c}_n") for c in CLASSES], *followers), "contexts") for part in pairs]
    with shuffles_removed(spark):
        sums = words.agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*CLASSES, "both")],
            *[F.count_if(F.col(c) > 0).alias(f"{c}_words") for c in CLASSES], F.count(F.lit(1)).alias("words"),
        ).first()

    def discounted(column: str) -> Column:
        return F.greatest(F.col(column) - DISCOUNT, F.lit(0.0))

    # Distinct words share what is discounted with one word more, which stands for all that are in neither class.
    unseen = DISCOUNT * sums["words"] / (sums["words"] + 1) / max(sums["both"], 1)
    shared_p = discounted("both") / max(sums["both"], 1) + unseen
    backoff = {c: DISCOUNT * sums[f"{c}_words"] / sums[c] if sums[c] else 1.0 for c in CLASSES}
    base = {c: float(np.log(backoff[c] * unseen)) if sums["words"] else 0.0 for c in CLASSES}
    likely = words.select("word", "both", *[(discounted(c) / max(sums[c], 1) + backoff[c] * shared_p).alias(f"{c}_p") for c in CLASSES])
    freed = {c: F.when(F.col(f"{c}_n") > 0, F.ln(DISCOUNT * F.col(f"{c}_kinds") / F.col(f"{c}_n"))).otherwise(0.0) for c in CLASSES}
    gain = {c: F.when(F.col(c) > 0, F.log1p(discounted(c) / (DISCOUNT * F.col(f"{c}_kinds") * F.col(f"{c}_p")))).otherwise(0.0) for c in CLASSES}
    pair_n, context_n = F.col("ordinary") + F.col("toxic"), sum(F.col(f"{c}_n") for c in CLASSES)
    context_key = F.col("context").bitwiseXOR(F.lit(_CONTEXT))
    few_words = frame_bytes(likely) <= BROADCAST_BYTES
    hot_words = None
    if not few_words:
        with shuffles_removed(spark):
            sizes = [(r["both"], r["rows"]) for r in words.groupBy("both").agg(F.count(F.lit(1)).alias("rows")).collect()]
        hot_words, _ = _least_count(sizes, HOT_WORDS)

    def with_words(part: DataFrame) -> DataFrame:
        """Bigrams with their words' probabilities; only bigrams of words that are not among the most frequent are moved."""
        known = likely.drop("both")
        if few_words or hot_words is None:
            return part.join(F.broadcast(known) if few_words else known, "word")
        hot = F.broadcast(likely.where(F.col("both") >= hot_words).drop("both"))
        rest = likely.where(F.col("both") < hot_words).drop("both")
        return part.join(hot, "word").unionAll(part.join(hot, "word", "left_anti").join(rest, "word"))

    def terms(turn: int, wanted: Callable[[Column], Column], few: bool = False) -> DataFrame:
        """Terms of the expressions of a round whose count is ``wanted``; if they are ``few``, the counts they meet are not moved."""
        own = likely.where((_round_column("word", rounds) == turn) & wanted(F.col("both")))
        of_words = own.select(F.col("word").alias("key"), *[(F.ln(f"{c}_p") - base[c]).alias(c) for c in CLASSES], F.lit(True).alias("word"))
        of_contexts = contexts[turn].where(wanted(context_n)).select(context_key.alias("key"), *[freed[c].alias(c) for c in CLASSES], F.lit(False).alias("word"))
        joined, kinds, known = pairs[turn].where(wanted(pair_n)), contexts[turn].select("context", *[f"{c}_kinds" for c in CLASSES]), likely.drop("both")
        if few:
            joined = known.join(F.broadcast(kinds.join(F.broadcast(joined), "context")), "word")
        else:
            joined = with_words(joined).join(kinds, "context")
        of_pairs = joined.select(_bigram_key_column().alias("key"), *[gain[c].alias(c) for c in CLASSES], F.lit(False).alias("word"))
        return of_words.unionAll(of_contexts).unionAll(of_pairs)

    # The least count of those that are sent, from the number of expressions by count.
    counted = [likely.select(F.col("word").alias("key"), F.col("both").alias("n"))]
    counted += [part.select(context_key.alias("key"), context_n.alias("n")) for part in contexts]
    counted += [part.select(_bigram_key_column().alias("key"), pair_n.alias("n")) for part in pairs]
    every = reduce(DataFrame.unionAll, counted)
    with shuffles_removed(spark):
        sizes = [(r["n"], r["rows"]) for r in every.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()]
    least, sent = _least_count(sizes, most)
    left = sum(found for _, found in sizes) - sent
    everything = reduce(DataFrame.unionAll, [terms(turn, lambda n: F.lit(True)) for turn in range(rounds)])
    columns = ["key", "toxic", "ordinary"]
    hot = pa.table({"key": pa.array([], pa.int64()), "toxic": pa.array([], pa.float64()), "ordinary": pa.array([], pa.float64())})
    if least is not None:
        for turn in range(rounds):
            with shuffles_removed(spark):
                hot = pa.concat_tables([hot, terms(turn, lambda n: n >= least, few=True).select(*columns).toArrow().cast(hot.schema)])
    keys = hot["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    values = np.stack([hot["toxic"].to_numpy()[order], hot["ordinary"].to_numpy()[order]], axis=1)
    others = np.zeros(FILTER_SLOTS, dtype=np.uint64)
    if left:
        rare = every.where(F.col("n") < least) if least is not None else every
        with shuffles_removed(spark):
            others = _filter_of(rare.select("key"))
    known = Terms(keys[order], values, others, np.array([base["toxic"], base["ordinary"]]))
    unsent = [terms(turn, lambda n: n < least if least is not None else F.lit(True)) for turn in range(rounds)]
    buckets = max(8, left // (rounds * TERMS_PER_BUCKET))
    counts = [list(part) for part in zip(pairs, contexts, strict=True)]
    counts[-1].append(words)
    return Model(everything, spark.sparkContext.broadcast(known), base, unsent, buckets, counts)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)


def _packed(rows: np.ndarray, first: int, *values: np.ndarray) -> bytes:
    """The number of ``first`` rows, which are of words, the row numbers, and the values of each row."""
    return b"".join([np.array([first, len(rows)], dtype="<u4").tobytes(), rows.astype("<u2").tobytes(), *[one.tobytes() for one in values]])


def _unpacked(blob: bytes, kind: type, columns: int) -> tuple[int, np.ndarray, list[np.ndarray]]:
    first, n = np.frombuffer(blob, dtype="<u4", count=2).tolist()
    rows = np.frombuffer(blob, dtype="<u2", count=n, offset=8).astype(np.int64)
    return first, rows, [np.frombuffer(blob, dtype=kind, count=n, offset=8 + 2 * n + k * 8 * n) for k in range(columns)]


def _asked(shared: Broadcast, turn: int, rounds: int, buckets: int):
    """Map of (hash, text) to the lookups of a block in each bucket.

    One row of each block has in ``head`` the hashes of its distinct texts and, in the order of ``SUMS``, what the
    terms sent bring in this round.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for block in blocks(batch, "text", SCORED_BYTES):
                hashes = block.column("hash").to_numpy(zero_copy_only=False)
                # Of equal texts in a block one asks.
                block = block.take(pa.array(np.sort(np.unique(hashes, return_index=True)[1])))
                hashes = block.column("hash").to_numpy(zero_copy_only=False)
                words, contexts, offsets = _bigrams(block.column("text"))
                row = np.repeat(np.arange(len(hashes)), np.diff(offsets))
                made = np.zeros((len(SUMS), len(hashes)))
                made[0] = np.diff(offsets) if turn == 0 else 0
                of_words, of_contexts = _round(words, rounds) == turn, _round(contexts, rounds) == turn
                open_keys, open_rows = [], []
                for order, (keys, own) in enumerate(zip(_keys(words, contexts), (of_words, of_contexts, of_contexts), strict=True)):
                    keys, at = keys[own], row[own]
                    terms, state = known.of(keys)
                    for k in range(2):
                        made[3 + k] += np.bincount(at, weights=terms[:, k], minlength=len(hashes))
                    if order == 0:
                        made[1:3] = made[3:5]
                        sent = state == 1
                        _add_words(made, at[sent], terms[sent, 0] - terms[sent, 1] + known.base[0] - known.base[1])
                    open_keys.append(keys[state == 2])
                    open_rows.append(at[state == 2])
                first = np.arange(sum(map(len, open_keys))) < len(open_keys[0])
                keys, at = np.concatenate(open_keys), np.concatenate(open_rows)
                bucket = _bucket(keys, buckets)
                order = np.argsort((bucket << 33) | (~first).astype(np.int64) << 32 | at, kind="stable")
                keys, at, first, bucket = keys[order], at[order], first[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                ends = np.append(cuts, len(bucket))[1:]
                blobs = [_packed(at[a:b], int(first[a:b].sum()), keys[a:b]) for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)]
                head = hashes.tobytes() + made.tobytes()
                heads = pa.array([head, *[None] * len(blobs)], pa.binary())
                into = pa.array([number % buckets, *bucket[cuts].tolist()], pa.int64())
                yield pa.record_batch([into, pa.array([number] * len(heads), pa.int64()), heads, pa.array([None, *blobs], pa.binary())], names=["bucket", "block", "head", "asks"])
                number += 1

    return asked


def _add_words(sums: np.ndarray, rows: np.ndarray, ratio: np.ndarray) -> None:
    """Take words of the given rows and class differences into telling and strongest."""
    told = ratio > TELLING
    sums[5] += np.bincount(rows[told], weights=ratio[told], minlength=sums.shape[1])
    np.maximum.at(sums[6], rows, ratio)


def _answers(terms: pa.Table, asks: pa.Table) -> pa.Table:
    """Answers to the lookups in a bucket: the terms of each word, and the sums by text of all others."""
    keys = terms["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], [terms[c].to_numpy()[order] for c in ("toxic", "ordinary")]
    answers = []
    for blob in asks["asks"].to_pylist():
        if blob is None or not len(keys):
            answers.append(None)
            continue
        first, rows, (wanted,) = _unpacked(blob, np.uint64, 1)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        n_words, rows, at = int(hit[:first].sum()), rows[hit], at[hit]
        found = [one[at] for one in values]
        # The rows ascend among words and among others.
        begins = np.flatnonzero(np.diff(rows[n_words:], prepend=-1)) + n_words
        summed = [np.concatenate([one[:n_words], np.add.reduceat(one, begins) if len(begins) else one[:0]]) for one in found]
        answers.append(_packed(np.concatenate([rows[:n_words], rows[begins]]), n_words, *summed))
    release_memory()
    return pa.table({"block": asks["block"], "head": asks["head"], "answer": pa.array(answers, pa.binary())})


def _block_sums(difference: float):
    """The sums of each text of a block from its head and the answers of all buckets; ``difference`` is that of the classes' base."""

    def added(rows: pa.Table) -> pa.Table:
        (head,) = [one for one in rows["head"].to_pylist() if one is not None]
        n = len(head) // (8 * (1 + len(SUMS)))
        hashes = np.frombuffer(head, dtype=np.int64, count=n)
        sums = np.frombuffer(head, dtype=np.float64, offset=8 * n).reshape(len(SUMS), n).copy()
        for blob in rows["answer"].to_pylist():
            if blob is None:
                continue
            first, at, (toxic, ordinary) = _unpacked(blob, np.float64, 2)
            for k, one in enumerate((toxic, ordinary)):
                sums[1 + k] += np.bincount(at[:first], weights=one[:first], minlength=n)
                sums[3 + k] += np.bincount(at, weights=one, minlength=n)
            _add_words(sums, at[:first], toxic[:first] - ordinary[:first] + difference)
        # The workers are idle while what follows runs in the JVM.
        release_memory()
        return pa.table({"hash": pa.array(hashes)} | {name: pa.array(sums[k]) for k, name in enumerate(SUMS)})

    return added


def text_sums(docs: DataFrame, model: Model, *, last: bool = False) -> DataFrame:
    """``SUMS`` of each distinct text of (hash, text), terms of words relative to the base, stored by hash.

    Equal texts of several blocks have equal sums in a round, of which one counts.  With ``last`` the model is not
    used again, and its counts go round by round.
    """
    sums = ", ".join(f"{name} double" for name in SUMS)
    bucket = F.expr(f"(key & {0xFFFFFF}) % {model.buckets}").alias("bucket")
    made = []
    for turn, wanted in enumerate(model.rounds):
        terms = stored(wanted, "terms")
        for done in model.counts[turn] if last else []:
            discard(done)
        asked = docs.mapInArrow(_asked(model.shared, turn, len(model.rounds), model.buckets), "bucket bigint, block bigint, head binary, asks binary")
        dealt = terms.select(bucket, "key", "toxic", "ordinary").groupBy("bucket").cogroup(asked.groupBy("bucket"))
        answered = dealt.applyInArrow(_answers, "block bigint, head binary, answer binary")
        added = answered.groupBy("block").applyInArrow(_block_sums(model.base["toxic"] - model.base["ordinary"]), f"hash bigint, {sums}")
        made.append(stored(added, "round-sums"))
        discard(terms)
    # All rows of a text are brought together once, after the last round.
    every = reduce(DataFrame.unionAll, [one.withColumn("turn", F.lit(turn)) for turn, one in enumerate(made)]).repartition("hash")
    one = every.groupBy("hash", "turn").agg(*[F.first(name).alias(name) for name in SUMS])
    total = one.groupBy("hash").agg(*[F.sum(name).alias(name) for name in SUMS[:-1]], F.max(SUMS[-1]).alias(SUMS[-1]))
    total = stored(total, "text-sums")
    for done in made:
        discard(done)
    return total


def hashed_texts(docs: DataFrame, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.xxhash64(content).alias("hash"), content.alias("text"))


def likelihoods(docs: DataFrame, model: Model, *, text: str = "text", sums: DataFrame | None = None) -> DataFrame:
    """Add a column ``_sums`` for each whole text; ``sums`` are the ``text_sums`` of these texts, if known.

    Its fields: words; the log-likelihoods word_toxic, word_ordinary (order 1) and all_toxic, all_ordinary
    (order 2); telling and strongest, sum and maximum over words of the classes' difference, the first where it is over ``TELLING``.
    """
    sums = text_sums(hashed_texts(docs, text), model) if sums is None else sums
    whole = {name: F.col(name) for name in SUMS}
    for name in SUMS[1:5]:
        whole[name] = F.col(name) + F.col("words") * F.lit(model.base[name.split("_")[1]])
    sums = sums.select(F.col("hash").alias("_sums_hash"), *[value.alias(f"_sums_{name}") for name, value in whole.items()])
    rows = docs.withColumn("_sums_hash", F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    rows = checked_join(rows, sums, "_sums_hash", "left")
    made = F.struct(*[F.col(f"_sums_{name}").alias(name) for name in SUMS])
    return rows.withColumn("_sums", made).drop(*sums.columns)


def features(docs: DataFrame, model: Model, *, text: str = "text", sums: DataFrame | None = None) -> DataFrame:
    """Add a column ``_features``: the values of ``FEATURES`` of each whole text; ``sums`` as in ``likelihoods``."""
    rows = likelihoods(docs, model, text=text, sums=sums)
    size = F.greatest(F.col("_sums.words"), F.lit(1.0))
    made = F.array(
        (F.col("_sums.all_toxic") - F.col("_sums.all_ordinary")) / size, (F.col("_sums.word_toxic") - F.col("_sums.word_ordinary")) / size,
        F.col("_sums.telling") / size, F.col("_sums.strongest"),
    )
    return rows.withColumn("_features", made).drop("_sums")


def fit_curve(values: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic curve, by Newton steps with a small ridge."""
    if not len(toxic) or toxic.min() == toxic.max():
        return np.zeros(len(FEATURES)), -np.inf
    center, scale = values.mean(axis=0), values.std(axis=0) + 1e-12
    design = np.column_stack([(values - center) / scale, np.ones(len(values))])
    weights = np.zeros(design.shape[1])
    ridge = np.append(np.full(len(FEATURES), 1.0), 1e-6)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip((design * weights).sum(axis=1), -30, 30)))
        gradient = (design * (toxic - p)[:, None]).sum(axis=0) - ridge * weights
        curvature = np.einsum("ni,n,nj->ij", design, p * (1 - p), design, optimize=False) + np.diag(ridge)
        weights += np.linalg.solve(curvature, gradient)
    plain = weights[:-1] / scale
    return plain, float(weights[-1] - (plain * center).sum())


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def calibration_split(marks: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Marks to be counted, and the at most ``rows`` of fold 3 with the least key hash, which fit the curve."""
    order, third = F.xxhash64("_key"), fold(F.col("_key")) == 3
    last = marks.where(third).select(order.alias("order")).orderBy("order").limit(rows).agg(F.max("order").alias("last")).first()["last"]
    held = third & (order <= F.lit(last)) if last is not None else F.lit(False)
    return marks.where(~held), marks.where(held)


def score(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, calibration_rows: int = CALIBRATION_ROWS
) -> DataFrame:
    """Add held_out, score (0 to 1) and predicted to ``docs``; columns of these names are replaced.

    ``labels`` has the key and toxic (0 or 1).  Fold 2 is held out; of fold 3 a
    bounded sample fits the curve, all other labelled texts are counted; keys and labels are used for this alone.
    """
    marks = labels.where(f"toxic is not null and {key} is not null").groupBy(F.col(key).alias("_key")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = stored(marks.where(fold(F.col("_key")) != 2), "toxic-marks")
    texts = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("text"))
    counted, held = calibration_split(marks, calibration_rows)
    training = checked_join(texts.where(fold(F.col("_key")) != 2), counted, "_key", "inner").select("text", "toxic")
    model = fit_model(training, rounds=rounds_for(texts))
    fitting = checked_join(texts.where(fold(F.col("_key")) == 3), held, "_key", "inner")
    sums = text_sums(hashed_texts(docs, text), model, last=True)
    rows = features(fitting, model, sums=sums).select(F.xxhash64("_key").alias("_order"), "toxic", "_features")
    sample = rows.orderBy("_order", "toxic").limit(calibration_rows).toPandas()
    values = np.array(sample["_features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    weights, intercept = fit_curve(values, sample["toxic"].to_numpy(float))

    # The documents' own columns are held in one, so that no name of theirs meets one from here.
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(F.struct(*own).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    scored = features(rows, model, sums=sums)
    if np.isfinite(intercept):
        total = F.lit(intercept)
        for k, weight in enumerate(weights.tolist()):
            total = total + F.element_at("_features", k + 1) * weight
        value = 1 / (1 + F.exp(-F.least(F.greatest(total, F.lit(-30.0)), F.lit(30.0))))
    else:
        value = F.lit(0.0)
    scored = scored.select("row.*", (fold(F.col("key")) == 2).alias("held_out"), value.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
