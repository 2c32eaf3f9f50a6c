import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from storelens.operators import skip_gram, vectors

SIZE = 4


@pytest.fixture(scope="module")
def topics(spark):
    """Sentences of 30 words of one of 20 topics, and some words of none."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(3_000):
        topic = rng.integers(20)
        rows.append(([f"the{rng.integers(5)}" if rng.random() < 0.3 else f"w{rng.integers(10)}_{topic}" for _ in range(30)],))
    kept = spark.createDataFrame(rows, "words array<string>").repartition(3).persist()
    yield kept
    kept.unpersist()


@pytest.fixture(scope="module")
def model(topics):
    return vectors.fit_word_vectors(topics, "words", min_count=20)


def test_words_of_a_topic_are_near_each_other(model):
    found = {row["word"]: np.array(row["vector"]) for row in model.getVectors().collect()}
    words = sorted(word for word in found if word.startswith("w"))
    assert len(words) == 200
    rows = np.array([found[word] / np.linalg.norm(found[word]) for word in words])
    similar = rows @ rows.T
    np.fill_diagonal(similar, -2)
    nearest = [words[k] for k in similar.argmax(axis=1)]
    assert np.mean([word.split("_")[1] == other.split("_")[1] for word, other in zip(words, nearest, strict=True)]) > 0.95


def test_training_is_repeatable(topics, model):
    again = vectors.fit_word_vectors(topics, "words", min_count=20)
    assert sorted(model.getVectors().collect()) == sorted(again.getVectors().collect())
    other = vectors.fit_word_vectors(topics, "words", min_count=20, seed=7)
    assert sorted(model.getVectors().collect()) != sorted(other.getVectors().collect())


def test_the_corpus_is_read_once_for_the_counts_and_once_for_the_training(spark, topics):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    read = topics.mapInArrow(counted, topics.schema)
    found = vectors.fit_word_vectors(read, "words", min_count=20)
    assert seen.value == 2 * topics.count()
    given = vectors.fit_word_vectors(read, "words", min_count=20, counts=vectors.vocabulary(topics, "words", 1))
    assert seen.value == 3 * topics.count()
    assert sorted(found.getVectors().collect()) == sorted(given.getVectors().collect())


def test_a_batch_is_the_sum_of_its_pairs(monkeypatch):
    """Against a loop over all pairs, each block's updates computed from the state before it."""
    monkeypatch.setattr(skip_gram, "BLOCK", 30)
    monkeypatch.setattr(skip_gram, "GROUP", 3)
    monkeypatch.setattr(skip_gram, "BATCH", 10**6)
    monkeypatch.setattr(skip_gram, "ROUNDS", 1e-9)
    rng = np.random.default_rng(5)
    sentences = [rng.integers(0, 9, n).astype(np.int32) for n in (30, 12, 1, 17, 40, 3, 30)]
    counts = np.sort(np.bincount(np.concatenate(sentences), minlength=9))[::-1]
    tree = skip_gram.huffman(counts)
    found, trained = skip_gram.train(sentences, tree, SIZE, step=0.2, total=200.0, seed=1, task=2)
    assert trained.all()

    parent, branch = tree
    random, done = np.random.default_rng([1, 2]), 0
    words, inner = skip_gram.start_vectors(9, SIZE, 1).astype(float), np.zeros((9, SIZE))
    for block in (sentences[:1], sentences[1:4], sentences[4:5], sentences[5:]):
        n = sum(map(len, block))
        reach = random.integers(1, 6, n)
        add_words, add_inner, pairs = np.zeros_like(words), np.zeros_like(inner), np.zeros(9, int)
        alpha, k = 0.2 * (1 - done / 200.0), 0
        for sentence in block:
            for at, word in enumerate(sentence):
                for near in range(max(at - reach[k], 0), min(at + reach[k] + 1, len(sentence))):
                    if near == at:
                        continue
                    pairs[word] += 1
                    node = word
                    while node != 16:
                        above, side = parent[node] - 9, branch[node]
                        g = alpha * (1 - side - 1 / (1 + np.exp(-words[sentence[near]] @ inner[above])))
                        add_words[sentence[near]] += g * inner[above]
                        add_inner[above] += g * words[sentence[near]]
                        node = parent[node]
                k += 1
        random.permutation(int((-(-pairs // 3)).sum()))
        random.permutation(1)
        words, inner, done = words + add_words, inner + add_inner, done + n
    np.testing.assert_allclose(found, words, atol=1e-5)


def test_huffman_paths():
    counts = np.array([40, 30, 20, 5, 5])
    nodes, taken, length, place = skip_gram.paths(*skip_gram.huffman(counts))
    assert length.tolist() == [1, 2, 3, 4, 4]
    assert (nodes[:, 0] == 3).all()
    assert sorted(place) == [0, 1, 2, 3, 4]
    codes = ["".join(map(str, row[:n])) for row, n in zip(taken, length, strict=True)]
    assert [sorted(codes).index(code) for code in codes] == place.tolist()


def test_sentences_are_cut_and_unknown_words_left_out(spark):
    rows = [(["a", "x", None, "b"],), (None,), ([],), (["b"] * 2_500,), (["x"],)]
    found = skip_gram.encoded(spark.createDataFrame(rows, "words array<string>").coalesce(1), "words", pa.array(["a", "b"]))
    ids = [np.frombuffer(row["sentence"], np.int32) for row in found.collect()]
    assert sorted(map(len, ids)) == [2, 500, 1_000, 1_000]
    assert next(x.tolist() for x in ids if len(x) == 2) == [0, 1]


def test_words_without_neighbours_keep_their_start(spark):
    alone = spark.createDataFrame([(["a"],), (["b"],), (["c", "d"],), (["d", "c"],)], "words array<string>")
    found = {row["word"]: row["vector"].toArray() for row in vectors.fit_word_vectors(alone, "words", min_count=1).getVectors().collect()}
    start = skip_gram.start_vectors(4, vectors.VECTOR_SIZE, 42)
    # Most frequent first, then by word: c, d, a, b.
    assert np.allclose(found["a"], start[2]) and np.allclose(found["b"], start[3])
    assert sorted(found) == ["a", "b", "c", "d"]
    one = vectors.fit_word_vectors(alone, "words", min_count=2, vector_size=3, counts=alone.select(F.lit("c").alias("word"), F.lit(2).alias("n")).limit(1))
    assert one.getVectors().count() == 1
    with pytest.raises(ValueError, match="no word"):
        vectors.fit_word_vectors(alone, "words", min_count=9)
