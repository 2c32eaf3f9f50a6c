"""SentencePiece encoding and decoding by weighted finite-state transducers.

Encoding composes each input with two transducers: the normaliser, which writes
every kind of space alike and puts one in front of a text, and the pieces with
byte fallback.  A path of the second one spells the text in pieces; a pair of
neighbours that merging would not leave apart costs infinity, every other one
nothing, in the tropical semiring, where costs along a path add up and the least
path counts.  So the shortest path is the sequence that merging gives.  The
composition is made lazily and determinised (``piece_machine``): a state is the
set of paths of finite cost, an arc says which piece ends there on the shortest
path so far, and the path is read backwards from the end.  Byte fallback is an
arc over a character that is no piece.

Decoding is the inverse transducer: pieces and bytes to UTF-8, without the space
put in front.

Edge cases: a null or empty text has no ids, and no ids (or null) decode to an
empty text.  Ids that are no piece decode to nothing, null ids too, and bytes
that are no UTF-8 to U+FFFD.  The space sign of the model and a space are the
same to it, so the sign decodes to a space.  Repeated rows get equal ids; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from storelens.llm.common import blocks
from storelens.llm.piece_machine import MOST_STATES, PieceMachine, machine, prepared, read_model, segments, surfaces

BLOCK_BYTES = 4 << 20
MOST_PATHS = 200_000

_paths: dict[str, dict[str, bytes]] = {}
_inverses: dict[str, tuple[pa.Array, bool]] = {}


def shortest_path(compiled: PieceMachine, text: str) -> np.ndarray:
    """Ids on the shortest path of the composition with a normalised text."""
    arcs, state, taken = compiled.arcs, 0, []
    for char in text:
        arc = arcs[state].get(char) or compiled.compile(state, char)
        state = arc[0]
        taken.append(arc)
    ids, at = [], len(text)
    while at:
        _, piece, length, _ = taken[at - 1]
        if piece < 0:
            ids.extend(compiled.byte_ids[byte] for byte in reversed(text[at - 1].encode()))
        else:
            ids.append(piece)
        at -= length
    return np.array(ids[::-1], dtype=np.int32)


def encode_block(texts: pa.Array, path: str) -> pa.Array:
    """Lists of ids of a block of texts."""
    compiled = machine(path)
    known = _paths.setdefault(path, {})
    if len(compiled.arcs) > MOST_STATES:
        compiled.forget()
    if len(known) > MOST_PATHS:
        known.clear()
    parts, first, _ = segments(prepared(texts, compiled.dummy_prefix))
    coded = parts.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    for text in sorted(text for text in distinct if text not in known):
        known[text] = shortest_path(compiled, text).tobytes()
    paths = [known[text] for text in distinct]
    lengths = np.fromiter(map(len, paths), dtype=np.int64, count=len(paths)) // 4
    starts = np.append(0, np.cumsum(lengths))
    lists = pa.LargeListArray.from_arrays(starts, pa.array(np.frombuffer(b"".join(paths), dtype=np.int32)))
    every = np.append(0, np.cumsum(lengths[coded.indices.to_numpy()])) if len(parts) else np.zeros(1, np.int64)
    ids = lists.take(coded.indices).flatten() if len(parts) else pa.array([], pa.int32())
    return pa.ListArray.from_arrays(every[first].astype(np.int32), ids)


def _inverse(path: str) -> tuple[pa.Array, bool]:
    if path not in _inverses:
        model = read_model(path)
        _inverses[path] = pa.array(surfaces(model), pa.large_binary()), model.normalizer_spec.add_dummy_prefix
    return _inverses[path]


def decode_block(lists: pa.Array, path: str) -> pa.Array:
    """Texts of a block of lists of ids."""
    surface, dummy_prefix = _inverse(path)
    ids = lists.flatten()
    bounds = np.append(0, np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy())).astype(np.int64)
    inside = pa.compute.and_(pa.compute.greater_equal(ids, 0), pa.compute.less(ids, len(surface)))
    spelled = pa.compute.fill_null(surface.take(pa.compute.if_else(inside, ids, pa.scalar(None, ids.type))), b"")
    offsets = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[spelled.offset : spelled.offset + len(spelled) + 1]
    if not len(offsets):
        return pa.array([""] * len(lists), pa.string())
    data = spelled.buffers()[2] or pa.py_buffer(b"")
    begin, end = offsets[bounds[:-1]], offsets[bounds[1:]]
    raw = np.frombuffer(data, dtype=np.uint8)
    led = np.zeros(len(begin), dtype=bool)
    if dummy_prefix and len(raw):
        led = (begin < end) & (raw[np.minimum(begin, len(raw) - 1)] == 0x20)
    begin = begin + led
    return pa.array([bytes(memoryview(data)[a:b]).decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.string())


def encode(text: Column, path: str) -> Column:
    """Ids (array of int) of each text by the model at ``path``, without begin and end ids."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            whole = pa.record_batch([batch], names=["text"])
            found = [encode_block(block.column(0), path) for block in blocks(whole, "text", BLOCK_BYTES)]
            yield pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return encoded(text)


def decode(ids: Column, path: str) -> Column:
    """Text of each list of ids."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield decode_block(batch, path)

    return decoded(ids)


def _checksums(lists: pa.Array) -> list[int]:
    values = pa.compute.fill_null(lists.flatten(), 0).to_numpy().astype("<u4")
    ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy())
    begins = np.append(0, ends)[:-1]
    return [zlib.crc32(values[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def round_trip(text: Column, path: str) -> Column:
    """Each text encoded and decoded again: struct of n_ids, ids_crc32 (unsigned, ids as little-endian
    32-bit words) and the decoded text's equality with the text, the model's space sign taken as a space.

    The ids do not leave the worker; ``encode`` and ``decode`` give them and the texts as columns.
    """

    @F.arrow_udf("struct<n_ids:bigint,ids_crc32:bigint,round_trip:boolean>")
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            whole = pa.record_batch([batch], names=["text"])
            sizes, sums, equal = [], [], []
            for block in blocks(whole, "text", BLOCK_BYTES):
                lists = encode_block(block.column(0), path)
                sizes += pa.compute.list_value_length(lists).to_pylist()
                sums += _checksums(lists)
                plain = pa.compute.replace_substring(pa.compute.fill_null(block.column(0), ""), "\u2581", " ")
                equal += pa.compute.equal(decode_block(lists, path), plain).to_pylist()
            columns = [pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(equal, pa.bool_())]
            yield pa.StructArray.from_arrays(columns, ["n_ids", "ids_crc32", "round_trip"])

    return checked(text)
