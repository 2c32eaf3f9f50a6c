"""Words, tokens and codes against plain versions and the tokenizer libraries."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storelens.llm import piece_codec, queries, token_counts, word_bpe, words
from storelens.llm.piece_machine import machine

from tests.conftest import SMALL

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "a", " a", "  ", "a  b", "▁x ▁▁", "<s> hi </s>", "<0x0A>", "\n\n x\t", "日本語テキスト", "🙂🙂a", "a\x00b", "\r\n",
    "don't we'll", "<|endoftext|> a<|startoftext|>b", "é É ÉÀß×÷", "x123.45", "K Σς ΑΣ ﬁ ½", "a" * 3000, " " * 70 + "the", "ab\u0085c",
]


def random_texts(n: int, seed: int, alphabet: str = "aabcdeehhttÉé  \nABC▁日é🙂012.,'\"<>|x/=_-") -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()
    return ODD + random_texts(1500, 1) + [row["text"] for row in rows]


def plain_words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain_shingles(text: str | None) -> set[tuple[str, ...]]:
    found = plain_words(text)
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)} if len(found) >= 5 else ({tuple(found)} if found else set())


def test_word_hashes_stand_for_words(texts, monkeypatch):
    monkeypatch.setattr(words, "WINDOW", 64)
    hashes, offsets = words.word_hashes(pa.array(texts, pa.string()))
    wanted = [plain_words(t) for t in texts]
    assert np.diff(offsets).tolist() == list(map(len, wanted))
    names = dict(zip([w for line in wanted for w in line], hashes.tolist(), strict=True))
    assert [names[w] for line in wanted for w in line] == hashes.tolist()
    assert len(set(names.values())) == len(names)


def test_shingle_sets_have_the_sizes_of_plain_ones(texts):
    sets = words.shingle_sets(pa.array(texts, pa.string()).slice(3))
    assert list(map(len, sets)) == [len(plain_shingles(t)) for t in texts[3:]]
    assert words.shingle_sets(pa.array([], pa.string())) == []


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_counts_equal_the_library(texts, chunk):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = [len(ids) for ids in library.encode([t or "" for t in texts])]
    assert token_counts.count_block(pa.array(texts, pa.string()), PIECES, chunk).tolist() == wanted


def test_chunk_maps_compose_like_one_text():
    compiled = machine(PIECES)
    text = " the thing of" * 9 + "x" * 50
    for cuts in ([5, 6, 7, 40], [1, 60], list(range(1, 100, 3))):
        bounds = [0, *cuts, len(text)]
        maps = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = text[a:b]
            meet = next((k for k in range(len(part)) if part[k] == " " and (a + k == 0 or text[a + k - 1] != " ")), None)
            if meet is None:
                maps.append(token_counts.ChunkMap(part, False))
            else:
                state, n = compiled.ends(0, part[meet:])
                maps.append(token_counts.ChunkMap(part[:meet], True, n, state))
        assert token_counts.composed(maps, compiled).count == compiled.ends(0, text)[1]


def test_codes_equal_the_library_both_ways(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = library.encode([t or "" for t in texts])
    lists = piece_codec.encode_block(pa.array(texts, pa.string()), PIECES)
    assert lists.to_pylist() == wanted
    assert piece_codec.decode_block(lists, PIECES).to_pylist() == library.decode(wanted)


def test_decoding_of_odd_ids(spark):
    assert piece_codec.decode_block(pa.array([[5, None, 99_999, -3], None, []]), PIECES).to_pylist() == ["\x02", "", ""]
    rows = spark.createDataFrame([("a b",), (None,)], "text string")
    coded = rows.withColumn("ids", piece_codec.encode(F.col("text"), PIECES)).withColumn("back", piece_codec.decode(F.col("ids"), PIECES))
    assert [row["back"] for row in coded.collect()] == ["a b", ""]


def test_word_ids_equal_the_library(texts):
    library = Tokenizer.from_file(WORDS)
    ids, offsets = word_bpe.encoder(WORDS).encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [found.ids for found in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_queries_over_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in queries.QUERIES["op9_token_counts"](spark, SMALL).collect():
        n = len(library.encode(docs[row["doc_id"]]))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(docs[row["doc_id"]].encode()), n, n > 4096)
    for row in queries.QUERIES["op10_piece_codec"](spark, SMALL).collect():
        ids = np.array(library.encode(docs[row["doc_id"]]), dtype="<u4")
        assert (row["n_ids"], row["ids_crc32"], row["round_trip"]) == (len(ids), zlib.crc32(ids), True)


def test_counts_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (3, "a b", "z")], "doc_id long, text string, n_tokens string")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.with_token_counts(rows, PIECES, limit=1).collect())
    assert got == [(1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (3, 3, 2, True)]
    assert token_counts.with_token_counts(rows.limit(0), PIECES).count() == 0
