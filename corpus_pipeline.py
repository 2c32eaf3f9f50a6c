"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, secrets are removed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written
and read again as the next stage's docs.  All stages but the last keep the columns of documents.

Null, empty and very long texts, repeated rows and empty tables are handled as
the stage's operator says: a null or empty text is neither toxic nor a duplicate
nor has secrets, and is packed as one piece.  A column of ``documents`` by the name of one an operator adds
is kept as it came.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import ngram_join, packing, secrets, toxicity
from storelens.llm.common import stored
from storelens.sources.shop_views import table

END_ID = 1


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    own = [F.col(f"`{name}`") for name in docs.columns]
    held = docs.select(F.struct(*own).alias("_row"), "doc_id", "text")
    scored = toxicity.score(held, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.where("predicted = 0").select("_row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that with the smallest id."""
    return ngram_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, reported secrets replaced."""
    return secrets.redact_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

# No SQL expresses the models and the tokenizer; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
