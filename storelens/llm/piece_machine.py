"""A SentencePiece BPE model compiled into a deterministic machine over characters.

Merging pairs by rank gives one sequence of pieces, and a sequence is that one
exactly if each two neighbours alone would also be merged into themselves.  So the
encoding can be read off from left to right: of all pieces that end at a
position just one fits behind the pieces before it.  What has to be remembered
are the beginnings of pieces that may still be completed, each with the piece
in front of it, which are finitely many states.  States and arcs are made when
they are first needed and kept.

A space stands for the model's own space sign, which a text may hold as well;
both are the same to the model.  A character that is no piece is written as its
UTF-8 bytes; no piece reaches across it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from sentencepiece import SentencePieceProcessor
from sentencepiece.sentencepiece_model_pb2 import ModelProto

MOST_STATES = 150_000
MOST_REMEMBERED = 800_000

_SIGN = "▁"
_BPE, _NORMAL, _BYTE = 2, 1, 6
_START = -1

Arc = tuple[int, int, int, int]


def read_model(path: str) -> ModelProto:
    """The model file; an error if its rules are not those that the machine knows."""
    model = ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    if model.trainer_spec.model_type != _BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("only BPE models that leave characters as they are can be compiled")
    if not (rules.escape_whitespaces and model.trainer_spec.byte_fallback):
        raise ValueError("only models with escaped spaces and byte fallback can be compiled")
    return model


def surfaces(model: ModelProto) -> list[bytes]:
    """What each id stands for in a text."""
    processor = SentencePieceProcessor(model_proto=model.SerializeToString())
    found = []
    for number, piece in enumerate(model.pieces):
        if piece.type == _NORMAL:
            found.append(piece.piece.replace(_SIGN, " ").encode())
        elif piece.type == _BYTE:
            found.append(bytes([int(piece.piece[3:5], 16)]))
        else:
            found.append(processor.decode([number]).encode())
    return found


class PieceMachine:
    """Arcs are (next state, id of the piece ending here, its characters, tokens added).

    An arc with a negative id stands for a character written as bytes.
    """

    def __init__(self, path: str):
        model = read_model(path)
        self.dummy_prefix = model.normalizer_spec.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        for number, piece in enumerate(model.pieces):
            if piece.type == _NORMAL:
                surface = piece.piece.replace(_SIGN, " ")
                if " " in surface.lstrip(" "):
                    raise ValueError("a piece reaches across a space")
                self.ids[surface], self.scores[surface] = number, piece.score
            elif piece.type == _BYTE:
                self.byte_ids[int(piece.piece[3:5], 16)] = number
        self.pieces = {number: surface for surface, number in self.ids.items()}
        self.open = {surface[:n] for surface in self.ids for n in range(1, len(surface))}
        self._fitting: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Drop all states; state 0 is the start."""
        self.arcs: list[dict[str, Arc]] = []
        self._numbers: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._number((("", _START, 0),))

    def _number(self, state: tuple) -> int:
        known = self._numbers.get(state)
        if known is None:
            known = self._numbers[state] = len(self._states)
            self._states.append(state)
            self.arcs.append({})
        return known

    def merged(self, text: str) -> list[str]:
        """The pieces by merging the best neighbours again and again, the leftmost of equals first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether the piece may follow the other in an encoding."""
        if before < 0:
            return True
        known = self._fitting.get((before, piece))
        if known is None:
            a, b = self.pieces[before], self.pieces[piece]
            known = self._fitting[before, piece] = self.merged(a + b) == [a, b]
        return known

    def compile(self, state: int, char: str) -> Arc:
        """Make the arc of a state for a character."""
        if char not in self.ids:
            arc = (0, -1, 1, len(char.encode()))
        else:
            going, found, length, since = [], -1, 0, 0
            for begun, before, tokens in self._states[state]:
                surface = begun + char
                piece = self.ids.get(surface)
                if piece is not None and found < 0 and self.fits(before, piece):
                    found, length, since = piece, len(surface), tokens
                if surface in self.open:
                    going.append((surface, before, tokens))
            if found < 0:
                raise AssertionError("no piece fits")
            # Tokens up to here less those up to where the piece began, plus the piece.
            added = 1 - since
            state_after = tuple((s, b, t + added) for s, b, t in going) + (("", found, 0),)
            arc = (self._number(state_after), found, length, added)
        self.arcs[state][char] = arc
        return arc

    def ends(self, state: int, text: str) -> tuple[int, int]:
        """The state after a text, and the tokens added on the way."""
        arcs, total = self.arcs, 0
        for char in text:
            arc = arcs[state].get(char) or self.compile(state, char)
            state = arc[0]
            total += arc[3]
        return state, total


_machines: dict[str, PieceMachine] = {}


def machine(path: str) -> PieceMachine:
    """The machine of a model file, compiled once in a worker."""
    if path not in _machines:
        _machines[path] = PieceMachine(path)
    return _machines[path]


def prepared(texts: pa.Array, dummy_prefix: bool) -> pa.Array:
    """Texts as the machine reads them: null is empty, one kind of space, one before each text that has any character."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), _SIGN, " ")
    if not dummy_prefix:
        return texts
    led = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, led)


def segments(texts: pa.Array, cut_every: int | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cut texts before each space that follows another character.

    Gives all segments in order, the offset of each text's first one (n + 1), and a
    mark on segments that begin at a space or a text's beginning, where the machine is as
    good as new.  ``cut_every`` also cuts after so many bytes, between characters;
    such segments are not marked unless they begin at a space by chance.
    """
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2] or pa.py_buffer(b"")
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffer, dtype=np.uint8)[low:high]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        space = data == 0x20
        fresh[1:-1] = space[1:] & ~space[:-1]
    fresh[offsets - low] = True
    fresh[-1] = False
    begins = fresh
    if cut_every is not None:
        begins = fresh.copy()
        for a, b in zip((offsets[:-1] - low).tolist(), (offsets[1:] - low).tolist(), strict=True):
            for at in range(a + cut_every, b, cut_every):
                while at < b and data[at] & 0xC0 == 0x80:
                    at += 1
                if at < b:
                    begins[at] = True
    begin = np.flatnonzero(begins)
    bounds = np.append(begin, len(data)) + low
    parts = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(bounds.astype(np.int64)), buffer)
    return parts, np.searchsorted(begin, offsets - low), fresh[begin]
