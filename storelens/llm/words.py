"""Vectorised words and word shingles of a block of texts, as 64-bit hashes.

Words are runs of characters other than space and the five ASCII controls
from tab to carriage return, with A-Z lower-cased.  A word's hash depends on its bytes alone, so
that equal words agree in all tasks.  Two different words share a hash with a
probability of about 2**-64, which the callers accept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WINDOW = 1 << 18
SHINGLE = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUES = mix((_LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLACES = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, WINDOW), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and each text's offset (n + 1); null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = filled.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the offset of each text's first word (n + 1)."""
    data, offsets = text_bytes(texts)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    space = _SPACE[data]
    begins = np.empty(len(data), dtype=bool)
    ends = np.empty(len(data), dtype=bool)
    if len(data):
        begins[0] = True
        begins[1:] = space[:-1]
        begins |= first[:-1]
        begins &= ~space
        ends[-1] = True
        ends[:-1] = space[1:]
        ends |= first[1:]
        ends &= ~space
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(begin), dtype=np.uint64)
    done = 0
    while done < len(begin):
        # As many whole words as fit in a window, one at least.
        low = begin[done]
        upto = max(int(np.searchsorted(end, low + WINDOW, side="right")), done + 1)
        high = end[upto - 1]
        values = _BYTE_VALUES[data[low:high]] * _power("up", _BASE, high - low)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(values, out=sums[1:])
        b, e = begin[done:upto] - low, end[done:upto] - low
        hashes[done:upto] = mix((sums[e] - sums[b]) * _power("down", _BASE_INVERSE, high - low)[b] + (e - b).astype(np.uint64))
        done = upto
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes: ``size`` words, or all of fewer; none without words."""
    words, offsets = word_hashes(texts)
    whole = np.zeros(max(len(words) - size + 1, 0), dtype=np.uint64)
    for k in range(size if len(whole) else 0):
        whole += words[k : k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    sets = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            few = (words[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(few + _PLACES[32 + b - a]))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
