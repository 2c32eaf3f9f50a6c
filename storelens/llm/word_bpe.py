"""Token ids of many texts by a word-level BPE tokenizer, each distinct word encoded once.

The tokenizer drops white space and never joins characters across it, nor
letters with punctuation or digits.  Words of plain letters, ASCII punctuation and
digits are cut there and merged for all distinct words of a block together, rank by
rank; every other word (apostrophes, marks that combine, other scripts, marks of
special tokens, very long words) is encoded by the tokenizer itself.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from storelens.llm.words import text_bytes

MOST_REMEMBERED = 250_000
MERGED_TOGETHER = 1 << 13
LONGEST = 40

_WHITE, _LETTER, _DIGIT, _PUNCTUATION, _OTHER = range(5)
_NONE = np.int32(1 << 30)

_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _WHITE
for _char in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
    _CLASS[ord(_char)] = _LETTER
for _char in "0123456789":
    _CLASS[ord(_char)] = _DIGIT
# Neither the apostrophe, which begins contractions, nor the bar of special tokens.
for _char in '!"#$%&()*+,-./:;<=>?@[\\]^_`{}~':
    _CLASS[ord(_char)] = _PUNCTUATION


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.library = Tokenizer.from_file(path)
        vocabulary = model["vocab"]
        suffix = model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], dtype=np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in letters], dtype=np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocabulary[a] << 16 | vocabulary[b] for a, b in pairs], dtype=np.int64)
        joined = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        ranks = np.arange(len(pairs), dtype=np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], ranks[order]
        self.joined = joined
        self.known: dict[bytes, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 16 | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of simple words, all words of about one length together."""
        found = [b""] * len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for low, high in ((0, 6), (6, 10), (10, 14), (14, 20), (20, LONGEST)):
            chosen = np.flatnonzero((lengths > low) & (lengths <= high))
            for begin in range(0, len(chosen), MERGED_TOGETHER):
                some = chosen[begin : begin + MERGED_TOGETHER]
                for k, ids in zip(some.tolist(), self._merge([words[k] for k in some.tolist()], lengths[some], high), strict=True):
                    found[k] = ids
        return found

    def _merge(self, words: list[bytes], lengths: np.ndarray, width: int) -> list[bytes]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        ids = self.inner[raw]
        rows = np.arange(len(words))
        ids[rows, lengths - 1] = self.last[raw[rows, lengths - 1]]
        counts = lengths.copy()
        columns = np.arange(width)
        ranks = np.full((len(words), width), _NONE, dtype=np.int32)
        if width > 1:
            ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
            ranks[columns[None, :] >= (lengths - 1)[:, None]] = _NONE
        going = rows
        while len(going):
            here = ranks[going]
            at = here.argmin(axis=1)
            best = here[np.arange(len(going)), at]
            more = best < _NONE
            going, at, best, here = going[more], at[more], best[more], here[more]
            if not len(going):
                break
            line = np.arange(len(going))
            shift = np.minimum(columns[None, :] + (columns[None, :] > at[:, None]), width - 1)
            tokens = np.take_along_axis(ids[going], shift, axis=1)
            tokens[line, at] = self.joined[best]
            here = np.take_along_axis(here, shift, axis=1)
            counts[going] -= 1
            left = at > 0
            here[line[left], at[left] - 1] = self._rank(tokens[line[left], at[left] - 1], tokens[line[left], at[left]])
            right = at + 1 < counts[going]
            here[line[~right], at[~right]] = _NONE
            here[line[right], at[right]] = self._rank(tokens[line[right], at[right]], tokens[line[right], at[right] + 1])
            here[columns[None, :] >= (counts[going] - 1)[:, None]] = _NONE
            ids[going], ranks[going] = tokens, here
        flat = ids[columns[None, :] < counts[:, None]]
        packed, ends = flat.tobytes(), 4 * np.cumsum(counts)
        return [packed[a:b] for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's offset (n + 1); null is empty."""
        data, offsets = text_bytes(texts)
        size = len(data)
        if not size:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        data = data.copy()
        kind = _CLASS[data]
        # Letters of two bytes from U+00C0 to U+00FF, without the two signs among them.
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        lead, tail = lead[(tail >= 0x80) & (tail != 0x97) & (tail != 0xB7)], tail[(tail >= 0x80) & (tail != 0x97) & (tail != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        white = kind == _WHITE
        first = np.zeros(size + 1, dtype=bool)
        first[offsets] = True
        word_begin = ~white
        word_begin[1:] &= white[:-1] | first[1:-1]
        begin = np.flatnonzero(word_begin)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        word = np.cumsum(word_begin) - 1
        odd_word = np.bincount(word[kind == _OTHER], minlength=len(begin)).astype(bool)
        odd = odd_word[np.maximum(word, 0)] & ~white
        # Simple words: lower case, and a cut where the class changes and at every digit.
        simple = ~odd
        upper = simple & (data >= 65) & (data <= 90)
        data[upper] += 32
        wide = lead[(tail <= 0x9E) & simple[lead]] + 1
        data[wide] += 0x20
        cut = word_begin.copy()
        cut[1:] |= ~white[1:] & simple[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        kept = ~white
        starts = np.flatnonzero(cut[kept])
        packed = data[kept]
        bounds = np.append(starts, len(packed)).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
        coded = parts.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        odd_part = np.zeros(len(distinct), dtype=bool)
        odd_part[codes[odd[kept][starts]]] = True
        self._learn(distinct, odd_part)
        known = self.known
        paths = [known[part] for part in distinct]
        lengths = np.fromiter(map(len, paths), dtype=np.int64, count=len(paths)) // 4
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(lengths)), pa.array(np.frombuffer(b"".join(paths), dtype=np.int32)))
        every = np.append(0, np.cumsum(lengths[codes]))
        ids = lists.take(coded.indices).flatten().to_numpy()
        position = np.append(0, np.cumsum(cut))
        return ids, every[position[offsets]]

    def _learn(self, distinct: list[bytes], odd: np.ndarray) -> None:
        if len(self.known) > MOST_REMEMBERED:
            self.known.clear()
        new = [(part, is_odd) for part, is_odd in zip(distinct, odd.tolist(), strict=True) if part not in self.known]
        plain = [part for part, is_odd in new if not is_odd and len(part) <= LONGEST]
        self.known.update(zip(plain, self.merge(plain), strict=True))
        rest = [part for part, is_odd in new if is_odd or len(part) > LONGEST]
        for part, found in zip(rest, self.library.encode_batch([part.decode() for part in rest], add_special_tokens=False), strict=True):
            self.known[part] = np.array(found.ids, dtype=np.int32).tobytes()


_encoders: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """The encoder of a tokenizer file, loaded once in a worker."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]
