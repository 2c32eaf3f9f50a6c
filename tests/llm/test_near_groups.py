"""Near-duplicate search on groups that share much and do not link."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from storelens.llm import ngram_join
from storelens.llm.words import shingle_sets


def altered(words, places, mark):
    return " ".join(f"{mark}x{k}" if k in places else word for k, word in enumerate(words))


def smallest_linked(sets, percent=75):
    """Smallest position reachable by links, by comparing all."""
    names = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                low, high = sorted((names[x], names[y]))
                names = [low if n == high else n for n in names]
    return names


def test_tokens_are_counted_over_all_tasks(spark):
    """A passage that no task meets twice is as frequent as one that one task has."""
    passage = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(k, f"first{k} {passage} last{k}") for k in range(20)], "id long, text string")
    for bits in (0, 3):
        found = ngram_join.frequent_tokens(docs.repartition(20, "id"), bits).collect()
        tokens = shingle_sets(pa.array([passage]))[0] >> np.uint64(32 - bits)
        assert {r["token"]: r["n"] for r in found} == dict.fromkeys(tokens.tolist(), 20)


def test_a_group_that_does_not_link_makes_few_rows(spark, monkeypatch):
    """Its documents share frequent tokens; pairs that sketches rule out are in no table."""
    rng = random.Random(5)
    words = [f"word{k}" for k in range(150)]
    texts = [altered(words, set(rng.sample(range(150), 6)), f"d{k}") for k in range(120)]
    texts += [altered(words, {k}, f"e{k}") for k in range(0, 150, 3)]
    rows, real = {}, ngram_join.stored

    def counted(df, name):
        out = real(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["component_id"] for r in sorted(got)] == smallest_linked(shingle_sets(pa.array(texts)))
    assert max(rows["candidates"], rows["possible"]) < 10 * len(texts) < len(texts) * (len(texts) - 1) / 4


def test_a_bucket_met_in_parts_gives_the_same(spark, monkeypatch):
    """A group larger than what meets at once loses no link between its parts."""
    rng = random.Random(7)
    words = [f"word{k}" for k in range(60)]
    texts = [altered(words, set(rng.sample(range(60), 1 + k % 2)), f"d{k}") for k in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "MEETING_ROWS", 12)
    largest, real = [], ngram_join.stored

    def watched(df, name):
        out = real(df, name)
        largest.extend(r["parts"] for r in out.collect()) if name == "sizes" else None
        return out

    monkeypatch.setattr(ngram_join, "stored", watched)
    got = ngram_join.link_documents(docs).collect()
    assert [r["component_id"] for r in sorted(got)] == smallest_linked(shingle_sets(pa.array(texts)))
    assert max(largest) > 2


def test_sketches_rule_out_no_pair_that_links():
    rng = np.random.default_rng(3)
    sets = [np.zeros(0, dtype=np.uint64)]
    for size in (1, 5, 31, 32, 33, 300, 5_000):
        whole = rng.integers(0, 1 << 63, size=size, dtype=np.uint64)
        for share in (1.0, 0.98, 0.87, 0.76, 0.5):
            more = rng.integers(0, 1 << 63, size=int(size * rng.random() / 4), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([whole[rng.random(size) < share], more])))
    sketches = ngram_join.Sketches([ngram_join._sketch(s) for s in sets])
    x, y = (side.ravel() for side in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    may = sketches.may_link(x, y, 75)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(x, y, strict=True)])
    linked = 100 * both >= 75 * (sketches.sizes[x] + sketches.sizes[y] - both)
    assert may[linked].all()
    assert not may[(both == 0) & (sketches.sizes[x] > 20)].any()
