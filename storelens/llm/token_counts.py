"""Token counts by a finite-state tokenizer.

The tokenizer model is compiled into a deterministic transducer whose arcs carry
the number of tokens they add (``piece_machine``).  Each text is cut into chunks
of a fixed size at any character.  Every chunk is read by itself and gives its
map from the state at its begin to the state at its end and the tokens between:
behind the first place where all states meet (a space after another character)
the map no longer depends on the entering state, so it is kept as the head
before that place, a count, and the state at the end.  The maps of a text are
composed in a tree, as in a parallel prefix scan, which gives the same count as
reading it from its beginning.

Edge cases: a null or empty text has no tokens; a text without any space is one
head, through which the maps are composed character by character; repeated rows
are counted alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import blocks
from storelens.llm.piece_machine import MOST_REMEMBERED, MOST_STATES, PieceMachine, machine, prepared, segments

CHUNK_BYTES = 1 << 16
BLOCK_BYTES = 16 << 20

_remembered: dict[str, dict[str, int]] = {}


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the transducer.

    ``head`` is read from the entering state.  If ``meets`` is set, all states meet
    behind it; ``count`` tokens follow and the chunk ends in ``state``.
    """

    head: str
    meets: bool
    count: int = 0
    state: int = 0


def then(first: ChunkMap, second: ChunkMap, compiled: PieceMachine) -> ChunkMap:
    """The map of two chunks one behind the other."""
    if not first.meets:
        return ChunkMap(first.head + second.head, second.meets, second.count, second.state)
    state, added = compiled.ends(first.state, second.head)
    if second.meets:
        return ChunkMap(first.head, True, first.count + added + second.count, second.state)
    return ChunkMap(first.head, True, first.count + added, state)


def composed(maps: list[ChunkMap], compiled: PieceMachine) -> ChunkMap:
    """All maps in order, neighbours first, so that the depth is the logarithm of their number."""
    while len(maps) > 1:
        pairs = [then(a, b, compiled) for a, b in zip(maps[::2], maps[1::2], strict=False)]
        maps = pairs + maps[2 * len(pairs) :]
    return maps[0]


def count_block(texts: pa.Array, path: str, chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Tokens of each text of a block."""
    compiled = machine(path)
    known = _remembered.setdefault(path, {})
    if len(compiled.arcs) > MOST_STATES:
        compiled.forget()
    if len(known) > MOST_REMEMBERED:
        known.clear()
    parts, first, fresh = segments(prepared(texts, compiled.dummy_prefix), chunk_bytes)
    if not len(parts):
        return np.zeros(len(texts), dtype=np.int64)
    # Segments between two meeting places begin in the start state: equal ones are read once.
    coded = parts.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    # In order, so that one after the other takes mostly the same arcs.
    for text in sorted(text for text in distinct if text not in known):
        known[text] = compiled.ends(0, text)[1]
    counts = np.fromiter(map(known.__getitem__, distinct), dtype=np.int64, count=len(distinct))
    closed = np.append(fresh[1:], True)
    sums = np.append(0, np.cumsum(np.where(fresh & closed, counts[codes], 0)))
    totals = sums[first[1:]] - sums[first[:-1]]
    # What is left are segments cut by the end of a chunk: one map each.
    for row in np.unique(np.searchsorted(first, np.flatnonzero(~fresh), side="right") - 1).tolist():
        maps = []
        for k in range(int(first[row]), int(first[row + 1])):
            if not fresh[k]:
                maps.append(ChunkMap(parts[k].as_py(), False))
            elif not closed[k]:
                state, n = compiled.ends(0, parts[k].as_py())
                maps.append(ChunkMap("", True, n, state))
        whole = composed(maps, compiled)
        totals[row] += whole.count
    return totals


def token_count(text: Column, path: str, chunk_bytes: int = CHUNK_BYTES) -> Column:
    """Number of tokens of each text by the model at ``path``, without begin and end tokens."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            whole = pa.record_batch([batch], names=["text"])
            found = [count_block(block.column(0), path, chunk_bytes) for block in blocks(whole, "text", BLOCK_BYTES)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())

    return count(text)


def with_token_counts(docs: DataFrame, path: str, *, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit; columns of these names are replaced."""
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(column).cast("long"), "n_tokens": token_count(column, path)})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
