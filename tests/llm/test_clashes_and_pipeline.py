"""Columns by the operators' own names, the recall audit, and the pipeline against plain checks of each stage."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from storelens.llm import flat_graph, secrets, toxicity, url_reputation
from tests.conftest import SMALL
from tests.llm.test_operators import WORDS
from tests.llm.test_words_and_codes import plain_shingles

CLASHING = {"_hash": "a", "_check": "b", "_spans": "c", "_sums": "d", "_total": "e", "_features": "f", "_hostname": "g", "_suffixes": "h", "_by_me": "i", "row": "j", "body": "k", "host_": "l"}


def with_clashes(df):
    return df.withColumns({name: F.lit(value) for name, value in CLASHING.items()})


def test_own_columns_stay(spark):
    rows = [(1, "password = abcdefghijklmnop", 27, "s", "en"), (2, None, None, None, None), (3, "plain", 5, "s", "en")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, source string, lang string"))
    redacted = secrets.redact_documents(docs)
    assert redacted.dtypes == docs.dtypes
    rows = {r["doc_id"]: r.asDict() for r in redacted.collect()}
    assert "abcdefgh" not in rows[1]["text"] and rows[1]["n_chars"] == len(rows[1]["text"]) and rows[2]["text"] is None
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id bigint, toxic int")
    scored = toxicity.score(docs, labels)
    assert scored.columns == [*docs.columns, "held_out", "score", "predicted"]
    pages = with_clashes(spark.createDataFrame([(1, "http://a.example.com/en/x"), (2, None)], "page_id bigint, url string"))
    outcomes = spark.createDataFrame([("a.example.com", 3, 1)], "host string, n bigint, good bigint")
    judged = url_reputation.judge(pages, outcomes, [("block", "net", "/")])
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    for frame in (redacted, scored, judged):
        assert all({name: r[name] for name in CLASHING} == CLASHING for r in frame.collect())


@pytest.mark.parametrize("noise", [0.2, 0.28])
def test_links_over_many_overlapping_shards(spark, noise):
    """Groups of four around random points in 16 dimensions, in forty shards."""
    rng = np.random.default_rng(17)
    centres = rng.standard_normal((2000, 16))
    points = (np.repeat(centres, 4, axis=0) + noise * rng.standard_normal((8000, 16))).astype(np.float32)
    table = pa.table({"vec_id": np.arange(8000), "embedding": list(points)})
    got = flat_graph.link_vectors(spark.createDataFrame(table).repartition(4), rows_per_shard=200).toPandas()
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum() - 8000
    assert got["n_links"].sum() >= 0.95 * links
    assert got["n_links"].sum() <= links


def test_audit_counts_all_links(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((300, 4))
    nodes = spark.createDataFrame([(i, p.tolist(), 1 + i % 2) for i, p in enumerate(points)], "node bigint, vec array<double>, n bigint")
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.9) & ~np.eye(300, dtype=bool)
    wanted = int((linked * (1 + np.arange(300) % 2)[None, :]).sum())
    none = spark.createDataFrame([], "node bigint, links bigint, root bigint")
    assert flat_graph.audit(nodes, none, 0.9, 300) == (0, wanted)


def test_pipeline_against_plain_checks(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [(9001, None, "en", "s", None), (9002, "", None, "s", 0), (9003, " \t\n", "en", None, 3), (9004, first["text"], "en", "s", 1), (9004, first["text"], "en", "s", 1),
           (9005, "token: " + "Zz9" * 12, "en", "s", 1), (9006, "w " * 60_000, "en", "s", 1)]
    rows = with_clashes(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    stages, current = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = current
        current = stage(spark, before, str(tmp_path))
        current.write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        stages[name] = current
        if name != "packing":
            assert current.dtypes == before.dtypes
    kept = {r["doc_id"]: r["text"] for r in stages["toxicity"].collect()}
    assert {9001, 9002, 9003, 9005} <= set(kept)
    apart = {r["doc_id"]: r["text"] for r in stages["near_duplicates"].collect()}
    sets = {i: plain_shingles(t or "") for i, t in kept.items()}

    def linked(a, b):
        return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)

    assert not any(linked(sets[i], sets[j]) for i in apart for j in apart if i < j)
    for i in set(kept) - set(apart):
        assert any(linked(sets[i], sets[j]) for j in kept if j < i), i
    clean = {r["doc_id"]: r["text"] for r in stages["secrets"].collect()}
    assert set(clean) == set(apart) and "Zz9" * 12 not in clean[9005]
    assert not any(re.search("AKIA[A-Z0-9]{14}", t or "") for t in clean.values())
    tokenizer = Tokenizer.from_file(WORDS)
    lengths = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in clean.items()}
    pieces = {}
    for r in stages["packing"].collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == lengths
    assert all(sorted(p)[k][0] == sum(n for _, n in sorted(p)[:k]) for p in pieces.values() for k in range(len(p)))


def test_pipeline_of_no_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
