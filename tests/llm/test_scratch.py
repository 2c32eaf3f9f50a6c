"""What operators leave behind while they run: shuffle files, memory of Python workers."""

from __future__ import annotations

import os
import pickle
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from storelens.llm import packing, toxicity, words
from storelens.llm.common import ARROW_BYTES, SHUFFLE_CLEANUP, blocks, shuffles_removed, stored
from storelens.llm.word_bpe import encoder


def shuffles(spark):
    """Number of shuffles whose map outputs are still registered."""
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    return tracker.shuffleStatuses().size()


def test_stored_frames_leave_no_shuffle_files(spark):
    before, own = shuffles(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    kept = stored(rows.join(spark.range(50).withColumnRenamed("id", "k").repartition(3), "k"), "joined")
    assert shuffles(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == own
    assert sorted(kept.collect()) == sorted(rows.collect())
    with shuffles_removed(spark):
        assert rows.agg(F.sum("n").alias("n")).first()["n"] == 1000


def test_python_gets_small_batches_of_large_texts(spark):
    """What a batch holds is in memory four times over: on either side of two tasks."""
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    own = spark.conf.get(ARROW_BYTES, None)
    texts = spark.range(0, 2_000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    kept = stored(texts.mapInArrow(sizes, "bytes long"), "sizes")
    assert kept.agg(F.max("bytes")).first()[0] < 8e6 < kept.agg(F.sum("bytes")).first()[0]
    assert spark.conf.get(ARROW_BYTES, None) == own


def test_packing_plan_starts_no_workers_of_its_own(spark, monkeypatch):
    """Rows of a Python list would be read by workers besides those of the tokenizer, which stay."""
    made = []
    monkeypatch.setattr(spark.sparkContext, "parallelize", lambda *a, **k: made.append(a))
    docs = spark.sql("select id as doc_id, 'some text of a document' as text from range(5)")
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 1).count() == 5
    assert not made


def test_fitting_the_toxicity_model_leaves_no_shuffle_files(spark):
    rows = [(f"word{k} and word{k % 7} again", k % 2) for k in range(60)]
    training = spark.createDataFrame(rows, "text string, toxic int")
    before = shuffles(spark)
    model = toxicity.fit_model(training, most=10)
    assert shuffles(spark) <= before
    assert len(model.shared.value.keys) <= 10 < model.table.count()


def test_memory_of_a_packing_block():
    """A block's arrays take many times its text, in each Python worker."""
    texts = pa.array([f"word{k % 50} of a plain text, " * 40 for k in range(8_000)])
    tool = encoder(public_tokenizers.path("word_bpe_49k.json"))
    tool.encode(texts[:50])
    tracemalloc.start()
    for block in blocks(pa.record_batch([texts], names=["text"]), "text", packing.BLOCK_BYTES):
        tool.encode(block.column(0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6


def test_a_batch_leaves_no_freed_memory_behind():
    """What a batch took is given back after its last block, also where small arrays lie between."""
    def resident() -> int:
        with open("/proc/self/statm") as sizes:
            return int(sizes.read().split()[1]) * 4096

    batch = pa.record_batch([pa.array(["a text"] * 10)], names=["text"])
    list(blocks(batch, "text"))
    before = resident()
    for _ in blocks(batch, "text"):
        held = [bytes(60_000) for _ in range(3_000)]
        kept = held[-1]
        del held
    assert resident() - before < 60e6 and len(kept) == 60_000


def test_toxicity_frees_the_counts_of_each_round(spark, monkeypatch):
    """What a round has counted goes before the next one's lookups, and equal texts of many blocks are brought together once."""
    rows = [(f"word{k} and word{k % 7} again", k % 2) for k in range(60)]
    model = toxicity.fit_model(spark.createDataFrame(rows, "text string, toxic int"), most=10, rounds=3)
    names, there = [], []

    def watched(df, name):
        kept = stored(df, name)
        names.append(name)
        if name == "round-sums":
            there.append(sum(os.path.exists(one.removeprefix("file:")) for one in files))
        return kept

    files = [part[0].inputFiles()[0].replace("file://", "file:") for part in model.counts]
    monkeypatch.setattr(toxicity, "stored", watched)
    docs = spark.createDataFrame([(rows[k % 3][0],) for k in range(12)], "text string").repartition(4)
    assert toxicity.text_sums(toxicity.hashed_texts(docs, "text"), model, last=True).count() == 3
    assert there == [2, 1, 0] and names.count("text-sums") == 1


def test_the_filter_names_every_key_and_few_others(spark):
    keys = spark.range(5_000).select(F.xxhash64("id").alias("key")).repartition(3)
    known = keys.toArrow()["key"].to_numpy().view(np.uint64)
    others = toxicity._filter_of(keys)
    slots, bits = toxicity._filter_place(known)
    assert ((others[slots] >> bits) & np.uint64(1) == 1).all()
    assert 4_900 < sum(int(one).bit_count() for one in others[others > 0].tolist()) <= 5_000
    assert not toxicity._filter_of(keys.limit(0)).any()


def test_terms_send_no_table_of_places():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 2_000).astype(np.uint64) * np.uint64(2))
    terms = toxicity.Terms(keys, np.ones((len(keys), 2)), np.zeros(toxicity.FILTER_SLOTS, dtype=np.uint64), np.zeros(2))
    sent = pickle.dumps(terms)
    assert len(sent) < 8 * toxicity.FILTER_SLOTS + 100_000
    assert (pickle.loads(sent).of(keys)[1] == 1).all() and not pickle.loads(sent).of(keys + np.uint64(1))[1].any()


def test_toxicity_moves_only_bigrams_of_rare_words(spark, monkeypatch):
    """With words too many to send, the frequent ones still are; the terms stay the same."""
    rows = [(f"word{k % 9} and word{k % 7} rare{k}", k % 2) for k in range(60)]
    training = spark.createDataFrame(rows, "text string, toxic int")
    whole = sorted(map(tuple, toxicity.fit_model(training).table.collect()))
    monkeypatch.setattr(toxicity, "BROADCAST_BYTES", 0)
    for most in (1 << 18, 10, 0):
        monkeypatch.setattr(toxicity, "HOT_WORDS", most)
        assert np.allclose(whole, sorted(map(tuple, toxicity.fit_model(training, rounds=2).table.collect())), rtol=1e-12)


def test_memory_of_hashing_a_block_of_texts(monkeypatch):
    """What hashing holds is bounded by its window, and the hashes do not depend on it."""
    texts = pa.array([f"word{k % 999} of a plain text, " * 40 for k in range(1_000)] + ["x" * 300_000])
    words.word_hashes(texts)
    tracemalloc.start()
    hashes, offsets = words.word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    monkeypatch.setattr(words, "WINDOW", 1 << 20)
    assert (words.word_hashes(texts)[0] == hashes).all() and len(hashes) == offsets[-1]


def test_lookups_give_back_memory(monkeypatch):
    """Workers that answered lookups are idle while their terms' sums are joined; what they freed goes back before."""
    calls = []
    monkeypatch.setattr(toxicity, "release_memory", lambda: calls.append(1))
    terms = pa.table({"key": pa.array([5], pa.int64()), "toxic": [0.5], "ordinary": [0.25]})
    head = np.array([7], dtype=np.int64).tobytes() + np.zeros(len(toxicity.SUMS)).tobytes()
    ask = toxicity._packed(np.array([0]), 1, np.array([5], dtype=np.uint64))
    asks = pa.table({"block": pa.array([1, 1], pa.int64()), "head": pa.array([head, None], pa.binary()), "asks": pa.array([None, ask], pa.binary())})
    answered = toxicity._answers(terms, asks)
    assert calls == [1]
    sums = toxicity._block_sums(0.0)(answered).to_pylist()
    assert calls == [1, 1] and [(r["hash"], r["word_toxic"], r["word_ordinary"]) for r in sums] == [(7, 0.5, 0.25)]
