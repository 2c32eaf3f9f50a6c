"""Skip-gram word vectors with a hierarchical softmax, trained by tasks on their own sentences and averaged.

The method is that of Spark's ``Word2Vec``: every position in the corpus takes a random reach of at most ``WINDOW``
words, every word within it is trained to predict the word at the position along that word's path in a Huffman
tree, the step size falls with the words seen, every task trains its own copy of the start vectors, and a word's vector
is the mean over the tasks that trained it.  Spark's trainer does so pair by pair; this one takes ``BATCH`` positions
groups of pairs at a time, each of one predicted word, by a few array operations.  No pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the method, as in Spark's trainer.
WINDOW = 5
SENTENCE = 1_000
LARGEST_SCORE = 6.0
LEAST_STEP = 1e-4

#: Pairs of the same predicted word that are one group, and groups whose updates are computed from the same vectors;
#: fewer groups where a task would have less than so many rounds.
GROUP = 48
BATCH = 256
ROUNDS = 1_000
#: Words that are looked at together, below 2**16 with one more sentence, so that the numbers of their vectors fit 16 bits.
BLOCK = 60_000
#: Words of the vocabulary in one row of a task's result.
MERGED_WORDS = 256


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and branch of every node of the Huffman tree of falling counts: words first, then inner nodes, the root last."""
    n = len(counts)
    weight = [int(x) for x in counts] + [0] * (n - 1)
    parent, branch = np.zeros(2 * n - 1, np.int32), np.zeros(2 * n - 1, np.int8)
    word, inner = n - 1, n
    for node in range(n, 2 * n - 1):
        for side in (0, 1):
            if word >= 0 and (inner >= node or weight[word] < weight[inner]):
                child, word = word, word - 1
            else:
                child, inner = inner, inner + 1
            weight[node] += weight[child]
            parent[child], branch[child] = node, side
    return parent, branch


def paths(parent: np.ndarray, branch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word the inner nodes from the root on, the branches taken, their number, and its place from left to right.

    Short paths are filled up with a node that is none, of the number of inner nodes.
    """
    n = (len(parent) + 1) // 2
    node, ups = np.arange(n), []
    while len(below := np.flatnonzero(node != 2 * n - 2)):
        ups.append((below, parent[node[below]] - n, branch[node[below]]))
        node[below] = parent[node[below]]
    length = np.zeros(n, np.int16)
    for below, _, _ in ups:
        length[below] += 1
    nodes, taken = np.full((n, len(ups)), n - 1, np.int32), np.zeros((n, len(ups)), np.int8)
    for k, (below, above, side) in enumerate(ups):
        nodes[below, length[below] - 1 - k] = above
        taken[below, length[below] - 1 - k] = side
    place = np.empty(n, np.int32)
    place[_left_to_right(taken)] = np.arange(n, dtype=np.int32)
    return nodes, taken, length, place


def _left_to_right(taken: np.ndarray) -> np.ndarray:
    """The words in the order of their branches from the root on, 32 levels to a sorted number."""
    sorted_by = []
    for k in range(0, max(taken.shape[1], 1), 32):
        bits = taken[:, k : k + 32].astype(np.int64)
        sorted_by.append(bits @ (1 << np.arange(31, 31 - bits.shape[1], -1)))
    return np.lexsort(sorted_by[::-1])


def start_vectors(n: int, size: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).random((n, size), dtype=np.float32) - np.float32(0.5)) / np.float32(size)


def _add(table: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row to the one at its place; two single numbers at a time, as complex ones, of rows of even width."""
    pairs = np.arange(table.shape[1] // 2)
    cells = places.reshape(-1, 1).astype(np.int64) * len(pairs) + pairs
    np.add.at(table.view(np.complex64).reshape(-1), cells.reshape(-1), rows.view(np.complex64).reshape(-1))


def _blocks(sentences: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers and the number of their sentence, about ``BLOCK`` at a time."""
    held: list[np.ndarray] = []
    size = 0
    for sentence in sentences:
        held.append(sentence)
        size += len(sentence)
        if size >= BLOCK:
            yield np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])
            held, size = [], 0
    if size:
        yield np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.int32), [len(x) for x in held])


def train(
    sentences: Iterable[np.ndarray], tree: tuple[np.ndarray, np.ndarray], size: int, *, step: float, total: float, seed: int, task: int
) -> tuple[np.ndarray, np.ndarray]:
    """One task's vectors of all words, and which of them it trained; ``total`` words are expected in its sentences of at most ``SENTENCE`` words."""
    nodes, taken, length, place = paths(*tree)
    n, width = len(nodes), size + size % 2
    vectors, inner, trained = np.zeros((n, width), np.float32), np.zeros((n, width), np.float32), np.zeros(n, bool)
    vectors[:, :size] = start_vectors(n, size, seed)
    if n < 2:  # a tree of one word has nothing to learn
        return vectors[:, :size], trained
    branches = taken.astype(np.float32)
    random, done = np.random.default_rng([seed, task]), 0
    batch = int(np.clip(total * (WINDOW + 1) / GROUP / ROUNDS, 4, BATCH))
    for ids, sentence in _blocks(sentences):
        words, numbers = np.unique(ids, return_inverse=True)
        none = len(words)
        here = np.zeros((none + 1, width), np.float32)
        here[:none] = vectors[words]
        near, first, filled, target = _pairs(numbers.astype(np.uint16), sentence, none, random)
        word = words[target]
        trained[words[np.unique(near)]] = True

        # Groups of like path length and size make the batches; in a batch they stand from left to right in the tree,
        # so that on every level equal nodes stand together.
        order = random.permutation(len(word))
        order = order[np.argsort(((length[word] + 3) // 4 * 64 + filled)[order], kind="stable")]
        starts = np.arange(0, len(order), batch)
        for turn, at in enumerate(random.permutation(starts)):
            chosen = order[at : at + batch]
            chosen = chosen[np.argsort(place[word[chosen]])]
            alpha = step * max(1 - (done + len(ids) * turn / len(starts)) / total, LEAST_STEP)
            places = np.arange(int(filled[chosen].max()))
            valid = places < filled[chosen, None]
            context = np.where(valid, near[np.minimum(first[chosen, None] + places, len(near) - 1)], np.uint16(none))
            levels = int(length[word[chosen]].max())
            path = np.ascontiguousarray(nodes[word[chosen], :levels].T)

            inputs = np.take(here, context, axis=0)
            rows = np.take(inner, path, axis=0)
            outputs = rows.transpose(1, 0, 2)
            score = np.matmul(inputs, outputs.transpose(0, 2, 1))
            # The goal, 1 for the left branch, less the logistic function of the score.
            with np.errstate(over="ignore"):
                g = np.exp(score)
            g += 1
            np.reciprocal(g, out=g)
            g -= branches[word[chosen], None, :levels]
            g *= (valid * np.float32(alpha))[:, :, None]
            if max(score.max(), -score.min()) >= LARGEST_SCORE:
                g *= np.abs(score) < LARGEST_SCORE

            # A vector with many updates from one state would overshoot: their sum is kept to what its curvature allows,
            # which is at most the step times a quarter of the squared lengths of the other vectors.
            to_words = np.matmul(g, outputs)
            weight = alpha / 4 * np.einsum("lbd,lbd->lb", rows, rows).sum(axis=0)
            curved = np.bincount(context.reshape(-1), np.repeat(weight, len(places)), none + 1)
            to_words *= (1 / np.maximum(curved, 1)).astype(np.float32)[context][:, :, None]

            new = np.ones(path.shape, bool)
            np.not_equal(path[:, 1:], path[:, :-1], out=new[:, 1:])
            new = new.reshape(-1)
            weight = alpha / 4 * np.einsum("bkd,bkd->bk", inputs, inputs).sum(axis=1)
            curved = np.add.reduceat(np.tile(weight, levels), np.flatnonzero(new))
            share = (1 / np.maximum(curved, 1)).astype(np.float32)[np.cumsum(new) - 1].reshape(path.shape)
            g *= share.T[:, None, :]
            _add(inner, path, np.ascontiguousarray(np.matmul(g.transpose(0, 2, 1), inputs).transpose(1, 0, 2)))
            inner[n - 1] = 0
            _add(here, context, to_words)
            here[none] = 0
        vectors[words] = here[:none]
        done += len(ids)
    return vectors[:, :size], trained


def _pairs(words: np.ndarray, sentence: np.ndarray, none: int, random: np.random.Generator) -> tuple[np.ndarray, ...]:
    """All pairs of a word and one within reach, in groups of one word and at most ``GROUP`` near ones.

    Gives the near words, and for each group its first one, their number and the word.
    """
    reach = random.integers(1, WINDOW + 1, len(words))
    padded = np.full(len(words) + 2 * WINDOW, none, np.uint16)
    padded[WINDOW:-WINDOW] = words
    of = np.full(len(padded), -1, np.int32)
    of[WINDOW:-WINDOW] = sentence
    steps = np.delete(np.arange(-WINDOW, WINDOW + 1), WINDOW)
    by_word = np.argsort(words, kind="stable")
    around = by_word[:, None] + (steps + WINDOW)
    valid = (np.abs(steps) <= reach[by_word, None]) & (of[around] == sentence[by_word, None])
    near = padded[around][valid]
    found = np.bincount(words[by_word], weights=valid.sum(1), minlength=none).astype(np.int64)
    groups = -(-found // GROUP)
    word = np.repeat(np.arange(none), groups)
    earlier = GROUP * (np.arange(len(word)) - np.repeat(np.cumsum(groups) - groups, groups))
    first = (np.cumsum(found) - found)[word] + earlier
    return near, first, np.minimum(GROUP, found[word] - earlier).astype(np.int16), word


def encoded(df: DataFrame, words: str, vocabulary: pa.Array) -> DataFrame:
    """Column ``sentence``: the places in the vocabulary of a row's known words as 32-bit numbers, cut every ``SENTENCE`` of them."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            found = pc.index_in(column.flatten(), value_set=vocabulary)
            known = found.is_valid().to_numpy(zero_copy_only=False)
            ids = found.drop_null().to_numpy()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())
            ends = np.append(0, np.cumsum(known))[ends].tolist()
            pieces = [
                ids[a : min(a + SENTENCE, end)].tobytes() for start, end in zip([0, *ends[:-1]], ends, strict=True) for a in range(start, end, SENTENCE)
            ]
            yield pa.record_batch([pa.array(pieces, pa.binary())], names=["sentence"])

    return df.select(words).mapInArrow(encode, "sentence binary")


def fit(df: DataFrame, words: str, vocabulary: pa.Array, counts: np.ndarray, *, size: int, partitions: int, step: float, seed: int) -> DataFrame:
    """Columns ``word`` and ``vector`` of the given words, most frequent first with their counts, trained by so many tasks."""
    n = len(vocabulary)
    tree, expected = huffman(counts), float(counts.sum()) / partitions + 1

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = (np.frombuffer(x.as_buffer(), np.int32) for batch in batches for x in batch.column(0))
        vectors, met = train(sentences, tree, size, step=step, total=expected, seed=seed, task=TaskContext.get().partitionId())
        ids = np.flatnonzero(met).astype(np.int32)
        cuts = np.searchsorted(ids, np.arange(0, n + MERGED_WORDS, MERGED_WORDS)).tolist()
        for block, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                row = [block, TaskContext.get().partitionId(), ids[a:b].tobytes(), vectors[ids[a:b]].tobytes()]
                yield pa.record_batch([pa.array([x]) for x in row], names=["block", "task", "ids", "vectors"])

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, ids, rows in zip(batch.column("block").to_pylist(), batch.column("ids"), batch.column("vectors"), strict=True):
                if block not in sums:
                    sums[block] = np.zeros((MERGED_WORDS, size)), np.zeros(MERGED_WORDS, np.int64)
                at = np.frombuffer(ids.as_buffer(), np.int32) - block * MERGED_WORDS
                sums[block][0][at] += np.frombuffer(rows.as_buffer(), np.float32).reshape(-1, size)
                sums[block][1][at] += 1
        start = start_vectors(n, size, seed) if sums else None
        for block, (total, tasks) in sums.items():
            own = slice(block * MERGED_WORDS, min((block + 1) * MERGED_WORDS, n))
            total, tasks = total[: own.stop - own.start], tasks[: own.stop - own.start, None]
            mean = np.where(tasks > 0, total / np.maximum(tasks, 1), start[own]).astype(np.float32)
            offsets = pa.array(np.arange(0, mean.size + 1, size), pa.int32())
            vectors = pa.ListArray.from_arrays(offsets, pa.array(mean.reshape(-1)))
            yield pa.record_batch([vocabulary[own], vectors], names=["word", "vector"])

    shape = "block bigint, task bigint, ids binary, vectors binary"
    found = encoded(df, words, vocabulary).repartition(partitions).mapInArrow(trained, shape)
    # A row without words for every block, so that words which no task trained keep their start vectors.
    none = F.lit(b"")
    every = df.sparkSession.range(-(-n // MERGED_WORDS)).select(F.col("id").alias("block"), F.lit(-1).cast("bigint").alias("task"), none.alias("ids"), none.alias("vectors"))
    return found.unionAll(every).repartition("block").sortWithinPartitions("block", "task").mapInArrow(averaged, "word string, vector array<float>")
