"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    collision_search, flat_graph, gnat_codes, line_counts, ngram_join, packing, phrases, piece_codec, secrets, token_counts, toxicity, url_reputation, warc,
)
from storelens.llm.sql import CODES_SQL, LINES_SQL, PHRASES_SQL, URL_REPUTATION_SQL, WARC_SQL
from storelens.sources.shop_views import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged; the outcome of a page is the quality label of the document its path names."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    named = F.expr(r"try_cast(regexp_extract(path, '/([0-9]{1,18})(/|\\.html)?$', 1) as bigint)")
    located = pages.select(url_reputation.host_of(F.col("url")).alias("host"), url_reputation.path_of(F.col("url")).alias("path"))
    # Counted before the join, so that neither side repeats a key often.
    seen = located.select("host", named.alias("doc_id")).where("doc_id is not null").groupBy("host", "doc_id").agg(F.count(F.lit(1)).alias("pages"))
    labels = (
        table(spark, sf_dir, "labels").where("quality is not null").groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("labels"), F.sum(F.col("quality").cast("long")).alias("good"))
    )
    outcomes = seen.join(labels, "doc_id").groupBy("host").agg(
        F.sum(F.col("pages") * F.col("labels")).alias("n"), F.sum(F.col("pages") * F.col("good")).alias("good")
    )
    judged = url_reputation.judge(pages, outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE["op8_url_reputation"] = URL_REPUTATION_SQL


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the piece model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: number and checksum of its ids, and whether the text comes back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", piece_codec.round_trip(F.col("text"), path).alias("digest")).select("doc_id", "digest.*")


@query
def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("text_hash", "text_check")


@query
def op4_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")).drop("text")


@query
def op1_warc_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an archive record, read back through the merged index; pages are taken one second apart."""
    captured = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    captures = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", captured.alias("captured"), F.col("html").alias("payload"))
    merged = warc.archive_histories(captures)
    return merged.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op1_warc_histories"] = WARC_SQL


@query
def op2_flat_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return flat_graph.link_vectors(table(spark, sf_dir, "embeddings"))


@query
def op3_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    found = collision_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op11_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, the error summed by label, and the digest of the codebooks."""
    coded, books = gnat_codes.encode(table(spark, sf_dir, "embeddings"))
    summed = gnat_codes.with_label_errors(coded, F.col("_row.label"))
    digest = gnat_codes.books_digest(books) if books is not None else None
    return summed.select(
        F.col("_id").alias("vec_id"), F.col("_code").alias("code"), F.col("_error").alias("error"), F.col("_label_error").alias("label_error"),
        F.lit(digest).cast("string").alias("codebooks_sha256"),
    )


ORACLE["op11_gnat_codes"] = CODES_SQL


@query
def op12_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines: number of lines, how many went, digest of the rest."""
    cut = line_counts.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op12_line_counts"] = LINES_SQL


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_phrases"] = PHRASES_SQL
