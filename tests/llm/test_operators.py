"""Each operator against a plain version, on generated tables and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storelens.llm import collision_search, components, flat_graph, ngram_join, packing, queries, secrets, toxicity, url_reputation, warc, word_bpe
from tests.compare import connect, difference
from tests.conftest import SMALL
from tests.llm.test_words_and_codes import plain_shingles

WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE[name]) is None


# Archives


def test_archives_of_odd_pages(spark, tmp_path):
    tricky = "WARC/1.1\r\nContent-Length: 5\r\n\r\nx\r\n\r\n" * 40
    rows = [(1, "http://b.a/x", tricky), (2, "http://b.a/x", tricky), (2, "http://b.a/x", tricky), (3, None, None), (None, " http://c/\n", ""), (5, "http://b.a/", "é" * 600), (6, "q", "short"), (7, "q", "short")]
    pages = spark.createDataFrame([(i, u, f"2024-01-0{1 + k % 3}T00:00:00Z", p) for k, (i, u, p) in enumerate(rows)], "id long, url string, captured string, payload string")
    got = warc.archive_histories(pages, path=str(tmp_path / "w")).collect()
    digest = {i: hashlib.sha1((p or "").encode()).hexdigest() for i, _, p in rows}
    assert sorted((r["id"] or -1, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == sorted(
        (i or -1, len((p or "").encode()), "revisit" if i == 1 else "response", 2 if i == 1 else None) for i, _, p in rows
    )
    assert all(r["payload_digest"] == digest[r["id"]] for r in got)
    order = [(r["url_key"], r["captured"]) for r in sorted(got, key=lambda r: (r["key_range"], r["key_place"]))]
    assert order == sorted(order)
    assert warc.archive_histories(pages.limit(0), path=str(tmp_path / "e")).count() == 0


def test_histories_are_in_global_order_over_many_ranges(spark, tmp_path):
    pages = spark.range(3000).select("id", F.concat(F.lit("http://h"), F.col("id") % 3, F.lit(".org/")).alias("url"), F.lit("2024-01-01T00:00:00Z").alias("captured"), F.col("id").cast("string").alias("payload"))
    warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=400_000)
    got = warc.merge_runs(warc.read_runs(spark, str(tmp_path / "w")), range_rows=500).collect()
    assert len({r["archive"] for r in got}) > 3 and len({r["key_range"] for r in got}) > 3
    order = [(r["url_key"], r["captured"], r["id"]) for r in sorted(got, key=lambda r: (r["key_range"], r["key_place"]))]
    assert order == sorted(order) and len(order) == 3000


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 7, 8])
def test_loser_tree_merges(runs):
    rng = random.Random(runs)
    lists = [sorted((rng.randint(0, 20),) for _ in range(rng.randint(0, 12))) for _ in range(runs)]
    assert list(warc.LoserTree(lists)) == sorted(x for run in lists for x in run)


# Vectors


def vector_rows(seed=3):
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((400, 8))
    points[200:260] = points[0] + 0.02 * rng.standard_normal((60, 8))
    points[260:300] = points[1]
    points[300:340] = points[2:42] + 0.15 * rng.standard_normal((40, 8))
    rows = [(k, [float(x) for x in p]) for k, p in enumerate(points.astype(np.float32))]
    return rows + [(900, None), (901, [0.0] * 8), (902, [math.nan] * 8), (903, [math.inf] + [0.0] * 7), (904, [None] * 8), (905, []), (906, [1.0, 2.0])]


def reachable(n, links):
    least = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return least


@pytest.mark.parametrize("shard_rows", [6_000, 90])
def test_flat_graph_finds_the_links(spark, shard_rows):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in flat_graph.link_vectors(frame, shard_rows=shard_rows).collect()}
    points = np.array([v for _, v in rows[:400]], dtype=float)
    unit = points / np.sqrt((points**2).sum(axis=1))[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    wanted = near.sum(axis=1)
    found = np.array([got[k]["n_links"] for k in range(400)])
    assert (found <= wanted).all() and found.sum() >= 0.97 * wanted.sum()
    least = reachable(400, list(zip(*np.nonzero(near), strict=True)))
    assert sum(got[k]["component_id"] == least[k] for k in range(400)) >= 396
    for k in range(900, 907):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert len(got) == len(rows)
    assert flat_graph.link_vectors(frame.limit(0)).count() == 0


def test_collision_search_finds_the_nearest(spark):
    rows = vector_rows() + [(7, [9.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collision_search.nearest(frame, F.col("id") % 20 == 0, 5, block_rows=150, query_rows=9).collect()
    points = dict(rows[:400]) | {7: min(dict(rows[:400])[7], [9.0] * 8)}
    hits = 0
    for query in range(0, 400, 20):
        scored = sorted((math.dist(points[query], p), k) for k, p in points.items() if k != query)[:5]
        own = sorted((r["rank"], r["score"], r["id"]) for r in got if r["query_id"] == query)
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5] and [(s, k) for _, s, k in own] == sorted((s, k) for _, s, k in own)
        hits += len({k for _, k in scored} & {k for _, _, k in own})
        assert all(abs(s - math.dist(points[query], points[k])) < 1e-9 for _, s, k in own)
    assert hits >= 0.95 * 100
    few = collision_search.nearest(frame.where("vec_id < 3"), F.col("id") == 0, 5).collect()
    assert sorted(r["id"] for r in few) == [1, 2]
    assert collision_search.nearest(frame.limit(0), F.col("id") == 0, 5).count() == 0


def test_search_recall_on_the_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    points = np.array([r["embedding"] for r in rows], dtype=float)
    ids = np.array([r["vec_id"] for r in rows])
    got = queries.QUERIES["op3_collision_search"](spark, SMALL).collect()
    hits = 0
    for query in ids[ids % 100 == 0]:
        away = np.sqrt(((points - points[ids == query][0]) ** 2).sum(axis=1))
        away[ids == query] = np.inf
        hits += len(set(ids[np.lexsort((ids, away))[:10]].tolist()) & {r["vec_id"] for r in got if r["query_id"] == query})
    assert hits >= 0.9 * len(got)


# Components and near duplicates


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 440)] + [(500, k) for k in range(501, 560)] + [(3, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    least = reachable(600, links)
    assert got == {k: least[k] for k in {x for a, b in links if a != b for x in (a, b)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    base = [[word() for _ in range(rng.randint(20, 120))] for _ in range(12)]
    passage = [word() for _ in range(60)]
    texts = []
    for words in base:
        for _ in range(rng.randint(1, 25)):
            copy = words[:]
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    for k in range(40):
        texts.append(" ".join(passage + [word() for _ in range(5 + k)]))
    return texts + ["", None, "  ", "a b", "A  b", "a", "a b c d e f", "a b c d e f"]


def test_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 4)
    texts = near_copies()
    rows = [(3 * k + 1, text, "t") for k, text in enumerate(texts)]
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string, token string")).collect()
    sets = [plain_shingles(text) for text in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    least = reachable(len(sets), pairs)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(3 * k + 1, len(s), 3 * least[k] + 1) for k, s in enumerate(sets)]


def test_links_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, None), (5, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in ngram_join.link_documents(frame).collect()))
    assert got == [(-1, 0, -1), (-1, 2, 1), (1, 2, 1), (1, 2, 1), (4, 0, 4), (5, 1, 5)]
    assert ngram_join.link_documents(frame.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"), (None, "a b c d e f", "z"), (4, None, "x"), (4, None, "x"), (5, "q r", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n string")
    kept = sorted((r["doc_id"] or -1, r["n"]) for r in ngram_join.keep_one(frame).collect())
    assert kept == [(-1, "z"), (1, "y"), (4, "x"), (4, "x"), (5, "x")]


# Packing


def test_packing_of_documents(spark):
    library = Tokenizer.from_file(WORDS)
    docs = {r["doc_id"]: np.array([*library.encode(r["text"], add_special_tokens=False).ids, 1], dtype="<u4") for r in documents(spark)}
    got = queries.QUERIES["op4_cutting_stock_packing"](spark, SMALL).collect()
    pieces, filled = {}, {}
    for r in got:
        part = docs[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (len(part), zlib.crc32(part), len(docs[r["doc_id"]])) == (r["length"], r["ids_crc32"], r["doc_tokens"])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts, wholes in ((pieces, {k: len(v) for k, v in docs.items()}), (filled, None)):
        for key, spans in parts.items():
            spans.sort()
            assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
            size = sum(n for _, n in spans)
            assert size == wholes[key] if wholes else size <= 2048
    assert set(pieces) == set(docs) and sum(map(len, docs.values())) >= 0.95 * 2048 * len(filled)


def test_packing_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "", 5), (3, "word " * 5000, 5)], "doc_id long, text string, start int")
    got = packing.pack(rows, WORDS, 1, with_ids=True).collect()
    assert sorted((r["doc_id"], r["start"], r["length"]) for r in got) == [(1, 0, 1), (1, 0, 1), (2, 0, 1), (3, 0, 2048), (3, 2048, 2048), (3, 4096, 905)]
    assert all(zlib.crc32(np.array(r["ids"], dtype="<u4")) == r["ids_crc32"] for r in got)
    assert packing.pack(rows.limit(0), WORDS, 1).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_demand_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    demand = np.where(rng.random(64) < 0.6, rng.integers(0, 10 ** (1 + seed), 64), 0)
    plan = packing.packing_plan(demand, 64)
    used = np.zeros(64, dtype=int)
    for pattern, copies in plan:
        assert sum(c * n for c, n in pattern.items()) <= 64
        for c, n in pattern.items():
            used[c - 1] += n * copies
    assert (used == demand).all()
    columns, counts = packing.fractional_patterns(demand, 64)
    assert sum(copies for _, copies in plan) <= counts.sum() * 1.02 + 40


# Secrets


def plain_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
    found = [("assign", *m.span()) for m in assign.finditer(text or "") if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_secrets_of_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in documents(spark)}
    got = queries.QUERIES["op6_secret_ownership"](spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == set(docs) and any(r["spans"] for r in got)
    for r in got:
        spans = plain_spans(docs[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert set(listed.split(",")) <= set(r["spans"].split(","))


def test_owned_and_copied_candidates(spark):
    live, example = "ghp_" + "aB3" * 10, "ghp_" + "xY9" * 10
    rows = [(1, f"é key {live} end", "a"), (2, f"use {example}", "a"), (3, f"use {example}", "b"), (4, f"use {example}", "c"), (4, f"use {example}", "c"), (5, None, None), (6, "password: short", "a"), (7, "PASSWORD = 'abcdefgh1234'", None)]
    frame = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in secrets.find_secrets(frame).collect()}
    assert got[1]["spans"] == "provider:6:40,opaque:6:40" and got[1]["n_live"] == 2
    assert [got[k]["spans"] for k in (2, 3, 4, 5, 6)] == [""] * 5
    assert got[7]["spans"] == "assign:0:24"
    clean = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in secrets.redact_documents(frame).collect() if r["text"])
    assert clean[0] == (1, "é key [provider removed] end", 28) and len(clean) == 7
    assert (7, "[assign removed]'", 17) in clean
    assert secrets.find_secrets(frame.limit(0)).count() == 0


def test_near_copies_are_dealt_and_counted(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=16) + rng.normal(size=(400, 16)) * 0.02
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(points)], "vec_id long, embedding array<double>")
    got = flat_graph.link_vectors(rows, shard_rows=60).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(399, 0)}
    ready = rows.selectExpr("vec_id as node", "embedding as vec", "1L as n", "array(0L) as shards", "0L as shard", "7L as parts", "vec_id % 7 as part", "array(0L) as near")
    cells = flat_graph.dealt(ready).groupBy("shard", "cell", "block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("int")).alias("asks")).collect()
    assert len(cells) == 49 and max(r["n"] for r in cells) <= 2 * 58 and sum(r["asks"] for r in cells) == 7 * 400


# Toxicity


def test_toxicity_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_kneser_ney_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) for k, r in got.items())
    held = [(got[k]["score"], y) for k, y in labels.items() if got[k]["held_out"]]
    won = [(a > b) + (a == b) / 2 for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum(won) / len(won) > 0.7


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(2)
    plain = [f"w{k}" for k in range(60)]
    mixed = lambda toxic: " ".join(rng.choice(["idiot", "scum"] if toxic and k % 5 == 0 else plain) for k in range(40))
    rows = [(k, mixed(k % 3 == 0), "s") for k in range(300)] + [(900, None, "s"), (900, None, "s"), (None, "", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)] + [(None, 1), (900, None)], "doc_id long, toxic int")
    got = toxicity.score(frame, labels).collect()
    assert len(got) == 303 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["doc_id"] % 3 == 0) for r in got if r["doc_id"] not in (None, 900))
    assert {r["score"] for r in toxicity.score(frame, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(frame.limit(0), labels).count() == 0


def trained(spark, rows):
    return spark.createDataFrame(rows, "text string, toxic int")


def test_toxicity_looks_up_what_is_not_sent(spark):
    rng = random.Random(5)
    line = lambda: " ".join(f"w{min(int(rng.expovariate(0.1)), 40)}" for _ in range(80))
    rows = [(line() + (" bad w1" if k % 3 == 0 else " good w1"), int(k % 3 == 0)) for k in range(200)]
    texts = [r[0] for r in rows[:20]] + [rows[0][0], rows[0][0].upper(), None, "", "unknown words w1 bad w1", line()]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    features = []
    for most in (1 << 19, 10, 1):
        model = toxicity.fit_model(trained(spark, rows), most=most)
        assert len(model.shared.value.keys) <= most and model.table.count() > 60
        features.append([r["_features"] for r in toxicity.features(docs, model).orderBy("id").collect()])
        assert len(features[-1]) == len(texts)
    assert any(f != [0, 0, 0] for f in features[0])
    assert np.allclose(features[0], features[1], atol=1e-9) and np.allclose(features[0], features[2], atol=1e-9)


def plain_likelihoods(rows, text):
    """Log-likelihoods of a text by dictionaries: {class: (words alone, bigrams)}, straight from the formulas."""
    bigram = {c: Counter() for c in (0, 1)}
    for one, label in rows:
        words = one.lower().split()
        bigram[label].update(zip(["<"] + words, words))
    contexts = {c: {} for c in (0, 1, "both")}
    for c in (0, 1):
        for v, w in bigram[c]:
            contexts[c].setdefault(w, set()).add(v)
            contexts["both"].setdefault(w, set()).add(v)
    total = {c: sum(map(len, met.values())) for c, met in contexts.items()}
    d, size = toxicity.DISCOUNT, len(contexts["both"])

    def shared(w):
        return max(len(contexts["both"].get(w, ())) - d, 0) / total["both"] + d * size / total["both"] / (size + 1)

    def word(c, w):
        return max(len(contexts[c].get(w, ())) - d, 0) / total[c] + d * len(contexts[c]) / total[c] * shared(w)

    def after(c, v, w):
        seen = {x: n for (u, x), n in bigram[c].items() if u == v}
        if not seen:
            return word(c, w)
        return max(seen.get(w, 0) - d, 0) / sum(seen.values()) + d * len(seen) / sum(seen.values()) * word(c, w)

    vocabulary = [*contexts["both"], "never-seen"]
    assert all(abs(sum(word(c, w) for w in vocabulary) - 1) < 1e-9 for c in (0, 1))
    words = text.lower().split()
    return {c: (sum(math.log(word(c, w)) for w in words), sum(math.log(after(c, v, w)) for v, w in zip(["<"] + words, words))) for c in (0, 1)}


def test_toxicity_likelihoods_against_dictionaries(spark):
    rng = random.Random(11)
    line = lambda: " ".join(f"w{min(int(rng.expovariate(0.05)), 90)}" for _ in range(30))
    rows = [(line() + (" vile w1 once%d" % k if k % 4 == 0 else " kind w2"), int(k % 4 == 0)) for k in range(60)] + [("rare rare", 1), ("Rare pair", 0)]
    texts = [rows[0][0], rows[1][0], line(), "never seen words", "w1 vile never w1", "once0 w1", "RARE pair rare", "w1", "", rows[0][0], rows[0][0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(5)
    for most in (1 << 19, 20, 1):
        model = toxicity.fit_model(trained(spark, rows), most=most)
        got = {r["id"]: r["_sums"] for r in toxicity.likelihoods(docs, model).collect()}
        for k, text in enumerate(texts):
            plain = plain_likelihoods(rows, text)
            have = [(got[k].word_ordinary, got[k].all_ordinary), (got[k].word_toxic, got[k].all_toxic)]
            assert got[k].words == len(text.split()) and np.allclose(have, [plain[0], plain[1]], rtol=1e-9, atol=1e-9)


def test_toxicity_keeps_rare_expressions(spark):
    rows = [("a b c d e f", 0)] * 30 + [("a b zork c d", 1)] * 5 + [("f e once", 1)]
    model = toxicity.fit_model(trained(spark, rows))
    texts = ["b zork", "q zork", "e once", "a b", "never"]
    of = {r["text"]: r["_features"] for r in toxicity.features(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()}
    # A word met once counts; the toxic bigram says more than its word after a new context.
    assert of["q zork"][1] > 0.1 and of["e once"][1] > of["a b"][1] and of["q zork"][3] > 0.1
    assert of["b zork"][0] > of["q zork"][0]
    # Every word, every context (the begin too) and every bigram has a row.
    assert model.table.count() == 8 + 8 + 11


def test_toxicity_counts_all_but_the_calibration_sample(spark):
    marks = spark.range(400).select(F.col("id").alias("_key"), F.lit(1).alias("toxic")).where(toxicity.fold(F.col("_key")) != 2)
    counted, held = toxicity.calibration_split(marks, 10)
    kept, fitted = {r["_key"] for r in counted.collect()}, {r["_key"] for r in held.collect()}
    assert len(fitted) == 10 and all(zlib.crc32(str(k).encode()) % 4 == 3 for k in fitted)
    assert not kept & fitted and len(kept) + 10 == marks.count()
    assert toxicity.calibration_split(marks.limit(0), 10)[0].count() == 0


# URLs


def test_hosts_paths_and_rules(spark):
    urls = [None, "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://a.example.com/en/1", "x://b.net/fr/2", "x://net/es/", "x://b.net/de/", "x://notnet/fr/", "a://b?://c/d"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    outcomes = spark.createDataFrame([("b.net", 40, 0), ("a.org", 40, 40)], "host string, n long, good long")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_reputation.judge(pages, outcomes, queries.URL_RULES).orderBy("page_id").collect()]
    assert [g[:3] for g in got] == [
        ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/en/x", "www.example.com/en/"), ("a.example.com", "/en/1", "example.com/en/"),
        ("b.net", "/fr/2", "net/fr/"), ("net", "/es/", "net/es/"), ("b.net", "/de/", None), ("notnet", "/fr/", None), ("b", "", None),
    ]
    assert [got[k][3] for k in (3, 4, 5, 6, 7)] == ["allow", "block", "block", "block", "block"]
    assert url_reputation.judge(pages.limit(0), outcomes, ()).count() == 0
    assert url_reputation.judge(pages, outcomes.limit(0), ()).count() == len(urls)


def test_toxicity_in_rounds_leaves_a_part_of_the_shuffles_at_a_time(spark):
    """However many rounds there are, the sums agree; each round holds only its own expressions."""
    rng = random.Random(17)
    line = lambda: " ".join(f"w{min(int(rng.expovariate(0.05)), 90)}" for _ in range(30))
    rows = [(line() + (" vile w1" if k % 4 == 0 else " kind w2"), int(k % 4 == 0)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate([rows[0][0], rows[0][0], line(), None, "never seen", "w1 vile"])), "id long, text string").repartition(3)
    sums = []
    for rounds in (1, 3):
        model = toxicity.fit_model(trained(spark, rows), most=20, rounds=rounds)
        parts = [part.count() for part in model.rounds]
        assert len(parts) == rounds and sum(parts) == model.table.count() - len(model.shared.value.keys) and max(parts) <= sum(parts) * 1.5 / rounds + 20
        sums.append([r["_sums"] for r in toxicity.likelihoods(docs, model).orderBy("id").collect()])
    assert len(sums[0]) == 6 and np.allclose(sums[0], sums[1], rtol=1e-9, atol=1e-9)
