"""Code compression, line dedup and phrase mining against plain versions and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import gnat_codes, line_counts, phrases

# Code compression


@pytest.mark.parametrize("entries", [1, 2, 7, 30, 64])
@pytest.mark.parametrize("reach", [1, 3, 50, 2**24])
def test_tree_finds_the_nearest_entry_and_the_lowest_of_ties(entries, reach):
    rng = np.random.default_rng(entries * 100 + reach)
    book = rng.integers(-reach, reach + 1, (entries, 4))
    points = np.concatenate([rng.integers(-reach, reach + 1, (500, 4)), book, np.zeros((1, 4), np.int64)])
    index, squared = gnat_codes.nearest_entries(gnat_codes.build(book), book, points)
    every = gnat_codes._distances(points, book)
    assert (index == every.argmin(axis=1)).all() and (squared == every.min(axis=1)).all()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and the digest in plain Python; ``rows`` are (id, vector) that are kept."""
    cut = {k: [[math.floor(256 * x) for x in v[p * len(v) // parts : (p + 1) * len(v) // parts]] for p in range(parts)] for k, (_, v) in enumerate(rows)}
    first = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and (i not in first or v < rows[first[i]][1]):
            first[i] = k
    books = [[cut[first[i]][p] for i in sorted(first)[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            groups = defaultdict(list)
            for k in cut:
                groups[nearest(cut[k][p], p)[1]].append(cut[k][p])
            moved.append([[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else e for j, e in enumerate(books[p])])
        books = moved
    found = [[nearest(cut[k][p], p) for p in range(parts)] for k in cut]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [("".join(f"{j:02x}" for _, j in row), sum(d for d, _ in row)) for row in found], digest


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(k, [float(x) for x in rng.normal(0, 0.4, 32)]) for k in range(150)]
    good += [(151, good[3][1]), (152, [0.0] * 32), (7, good[9][1]), (7, good[7][1]), (None, good[2][1]), (-5, [-1.0 / 256] * 32), (-5, [-1.0 / 256] * 32)]
    bad = [(160, None), (161, []), (162, [math.nan] * 32), (163, [math.inf] + [0.0] * 31), (164, [None] * 32), (165, [1.0] * 16), (166, [1.0] * 33), (167, [1e300] * 32)]
    labels = [None, 1, 2]
    rows = [(i, v, None if i is None else labels[i % 3], "x") for i, v in good + bad]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, _vec string").repartition(5)
    coded, books = gnat_codes.encode(table)
    got = gnat_codes.with_label_errors(coded, F.col("_row.label")).collect()
    wanted, digest = plain_codes(good)
    assert gnat_codes.books_digest(books) == digest
    key = lambda x: str(x)
    assert sorted(((r["_id"], r["_code"], r["_error"]) for r in got), key=key) == sorted(((i, *w) for (i, _), w in zip(good, wanted, strict=True)), key=key)
    sums = Counter()
    for (i, _), (_, error) in zip(good, wanted, strict=True):
        sums[None if i is None else labels[i % 3]] += error
    assert all(r["_label_error"] == sums[r["_row"]["label"]] for r in got)
    assert {r["_row"]["_vec"] for r in got} == {"x"}


def test_codes_of_few_and_of_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    coded, books = gnat_codes.encode(empty)
    assert books is None and gnat_codes.with_label_errors(coded, F.col("_row.label")).count() == 0
    one = spark.createDataFrame([(3, [0.5] * 16, None)], "vec_id bigint, embedding array<float>, label int")
    (row,) = gnat_codes.with_label_errors(gnat_codes.encode(one)[0], F.col("_row.label")).collect()
    assert (row["_code"], row["_error"], row["_label_error"]) == ("00" * 16, 0, 0)


# Lines


def plain_lines(rows):
    """(lines, dropped, kept text) of each row (id, text)."""

    def key(line):
        return re.sub("^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$", "", line).translate({c: c + 32 for c in range(65, 91)})

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    rng = random.Random(4)
    pool = [f"a line that many documents share, number {k}" for k in range(12)] + ["short", "", "  ", "\t", "é" * 19, "é" * 20, "x" * 19, " X" + "x" * 19 + "\r", "日本語" * 7, "İ" * 20]
    rows = [(k, "\n".join(rng.choice([x, x.upper(), f"  {x}\t\r"]) for x in rng.choices(pool, k=rng.randint(0, 9)))) for k in range(120)]
    rows += [(500 + k, "\n".join([pool[0], "\x00nul and more signs than twenty\x1f", pool[1] + " " * k])) for k in range(40)]
    rows += [(None, pool[0] + "\n" + pool[1]), (600, None), (601, ""), (602, "\n\n"), (3, rows[3][1]), (3, pool[2]), (700, "y" * 300_000 + "\n" + pool[0]), (701, "y" * 300_000), (702, "y" * 300_000)]
    return rows


@pytest.mark.parametrize(("shard_keys", "asked_at_once"), [(50_000, 100_000), (3, 5)])
def test_lines_equal_plain_version(spark, shard_keys, asked_at_once):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, k, "own") for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, place int, kept_text string").repartition(6)
    got = line_counts.drop_repeated_lines(docs, shard_keys=shard_keys, asked_at_once=asked_at_once).collect()
    wanted = plain_lines(rows)
    assert {r["row"]["place"]: (r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got} == dict(enumerate(wanted))
    assert sum(w[2] for w in wanted) > 100 and {r["row"]["kept_text"] for r in got} == {"own"}
    assert line_counts.drop_repeated_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_numbers_every_key_once(n):
    rng = np.random.default_rng(n)
    hashes, checks = rng.integers(-(2**63), 2**63, n), rng.integers(-(2**31), 2**31, n).astype(np.int32)
    if n > 2:  # equal first halves must still come apart
        hashes[1] = hashes[0]
    made = line_counts.PerfectHash.of(hashes, checks)
    again = line_counts.PerfectHash.load(*made.dump())
    assert sorted(made(hashes, checks).tolist()) == list(range(n)) and (made(hashes, checks) == again(hashes, checks)).all()


# Phrases


def plain_phrases(rows, least=10, swallowed=50, top=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            words = [w for w in re.split("[ \t]", piece) if w]
            for k in (1, 2, 3):
                for at in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[at : at + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        dropped = {g[s : s + k] for g, a in candidates.items() for k in range(2, len(g)) for s in range(len(g) - k + 1) if 100 * a >= swallowed * candidates[g[s : s + k]]}
        n = sum(a for g, a in f.items() if len(g) == 1)
        scored = []
        for g, a in candidates.items():
            if g not in dropped:
                score, cut = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:cut]], f[g[cut:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n, -score) for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], start=1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    words = [*"abcdefgh", "The", "tHe", "é", "日本", "a-b", "x\x00y", " "]
    rows = [(" ".join(rng.choices(words, weights=[30, 9, 8, 7, 6, 5, 4, 3, 9, 9, 2, 2, 2, 2, 2], k=rng.randint(0, 60))), rng.choice(["en", "en", "de", None, ""])) for _ in range(200)]
    rows += [("of the .the of,the\tof  the\nof the;;", "en")] * 30 + [("same words same words", "fr")] * 4 + [(None, "en"), ("", None), (" \t.\n", "es"), ("z" * 200_000 + " q " * 9, "en")]
    rows += [("q " + "Z" * 200_000 + " " + "w" * 70_000, "en")] * 10
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_phrases_equal_plain_version(spark, parts):
    rows = phrase_rows()
    docs = spark.createDataFrame([(k, t, lang, "x", 1) for k, (t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string, word string, depth int").repartition(4)
    got = phrases.collocations(docs, parts=parts)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | dict.fromkeys(["rank", "a", "l", "r", "n", "score"], "bigint")
    wanted = plain_phrases(rows)
    assert sorted(map(tuple, got.collect())) == wanted and len(wanted) > 100
    assert sorted(map(tuple, phrases.collocations(docs, parts=parts, top=3).collect())) == plain_phrases(rows, top=3)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_slices_of_a_long_text_lose_no_suffix(spark, monkeypatch):
    rows = [(" ".join(f"w{k % 97}" for k in range(5000)), "en"), ("w1 w2 w3", "en")]
    monkeypatch.setattr(phrases, "SLICE_WORDS", 211)
    words = sum(int(n.sum()) for texts, langs in [([t for t, _ in rows], ["en", "en"])] for *_, n in phrases._slices(__import__("pyarrow").array(texts), langs))
    assert words == 5003


@pytest.mark.parametrize("seed", range(4))
def test_quicksort_counts_every_prefix(seed):
    rng = np.random.default_rng(seed)
    size, least = int(rng.integers(0, 4000)), int(rng.integers(1, 30))
    columns = (rng.zipf(1.5, (3, size)) % 40).astype(np.uint64) + np.uint64(1)
    columns[1, rng.random(size) < 0.1] = 0
    columns[2, (columns[1] == 0) | (rng.random(size) < 0.1)] = 0
    weights = rng.integers(1, 5, size)
    for depth, (pointers, n) in enumerate(phrases.quicksort_counts(columns, weights, least), start=1):
        plain = Counter()
        for k in range(size):
            if columns[depth - 1, k]:
                plain[tuple(columns[:depth, k].tolist())] += int(weights[k])
        assert {tuple(columns[:depth, p].tolist()): c for p, c in zip(pointers.tolist(), n.tolist(), strict=True)} == {g: c for g, c in plain.items() if c >= least}


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**14 - 1, 10**14 + 1, 10**14 + 7), (3, 7, 11), (10**12, 10**12, 10**13), (10**9 + 7, 2 * 10**9, 10**14)]
    frame = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    got = frame.select(phrases.cut_score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r["s"] for r in got] == [10**6 * a * a // (left * r) for a, left, r in rows]
