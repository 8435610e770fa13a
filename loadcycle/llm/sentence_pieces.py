"""SentencePiece encoding and decoding of merge-type models, by a table over the prefixes of the text.

The merges of a text give one sequence of pieces, and a sequence is that one exactly when every two neighbours are what
merging gives for their own text. So the pieces of a prefix are those of a shorter prefix and one more: a piece that ends
there and that is compatible with the last piece of the shorter prefix. The encoder keeps for each prefix that last
piece, which is unique. An automaton over all pieces gives the candidates at every place in one pass; a test of the pair,
remembered for later, picks the one. The ids are then read off the table from the end to the beginning.

A text is cut first where no piece of the vocabulary can lie across, so that words met before are not encoded again.
"""

from __future__ import annotations

import codecs
import hashlib
import os
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from loadcycle.llm.common import per_text

#: Parts and tested pairs remembered per worker; beyond that the tables start anew, so memory stays bounded.
MAX_PARTS, MAX_PART = 120_000, 64
MAX_PAIRS = 300_000

BLANK = "▁"

# Numbers of the fields, piece types and model types in a model file.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT, _SCORE, _TYPE = 1, 2, 3
_MODEL_TYPE, _SUFFIX, _FALLBACK, _UNKNOWN_SURFACE = 3, 24, 35, 44
_RULES, _PREFIX, _STRIP, _ESCAPE = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in the file."""
    at = 0

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    """What the encoder needs of a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    prefix: bool  # a blank is put before the text
    fallback: bool  # characters without a piece become their bytes
    unknown: str  # what an unknown id is decoded to


def read_model(path: str) -> Model:
    """A model file of merge type whose normalisation is the identity; others are refused."""
    pieces, trainer, normalizer = [], {}, {}
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == _PIECES:
                told = dict(_fields(value))
                score = struct.unpack("<f", told.get(_SCORE, b"\0\0\0\0"))[0]
                pieces.append((told.get(_TEXT, b"").decode(), score, told.get(_TYPE, NORMAL)))
            elif number == _TRAINER:
                trainer = dict(_fields(value))
            elif number == _NORMALIZER:
                normalizer = dict(_fields(value))
    if trainer.get(_MODEL_TYPE, 1) != MERGES:
        raise ValueError("the model is not of merge type")
    if normalizer.get(_RULES) or normalizer.get(_STRIP, 1) or not normalizer.get(_ESCAPE, 1) or trainer.get(_SUFFIX, 0):
        raise ValueError("only models that leave texts as they are, but for blanks, are read")
    texts, scores, kinds = zip(*pieces)
    if set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("models with pieces defined by users or out of use are not read")
    surface = trainer.get(_UNKNOWN_SURFACE, " ⁇ ".encode())
    return Model(texts, scores, kinds, bool(normalizer.get(_PREFIX, 1)), bool(trainer.get(_FALLBACK, 0)), surface.decode())


def merge_by_score(text: str, rank: dict[str, int]) -> list[str]:
    """The definition: merge the neighbours of best rank, leftmost first, until none is in the vocabulary."""
    never = len(rank) + 1
    parts = list(text)
    merged = [rank.get(a + b, never) for a, b in zip(parts, parts[1:])]
    while merged:
        best = min(merged)
        if best == never:
            break
        i = merged.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del merged[i]
        if i < len(merged):
            merged[i] = rank.get(parts[i] + parts[i + 1], never)
        if i:
            merged[i - 1] = rank.get(parts[i - 1] + parts[i], never)
    return parts


def safe_cuts(pieces: Iterable[str]) -> str:
    """A pattern whose matches cover a text and between which no piece can lie.

    A match is a run of blanks, then of other characters, then of word characters, so pieces may hold these three in this
    order only. Word characters that some piece holds before another character count as others; where that does not
    help, the whole text is one match.
    """
    joined, others = {a + b for p in pieces for a, b in zip(p, p[1:])}, set()

    def kind(c: str) -> int:
        return 0 if c == BLANK else 2 if re.match(r"\w", c) and c not in others else 1

    while more := {a for a, b in joined if kind(a) == 2 and kind(b) == 1}:
        others |= more
    if any(kind(a) > kind(b) for a, b in joined):
        return r"(?s:.+)"
    apart = re.escape("".join(sorted(others)))
    word, other = rf"[^\W{apart}]", rf"(?:[^\w{BLANK}]" + (rf"|[{apart}])" if apart else ")")
    middle = f"{other}*+" if any(kind(a) == 1 and kind(b) == 2 for a, b in joined) else ""
    return rf"{BLANK}*+{middle}{word}++|{BLANK}*+{other}++|{BLANK}++"


class PrefixTable:
    """Cuts a text into pieces by the last piece of each prefix.

    Every character of the text must be one that occurs in some piece; a character that is no piece itself stands
    for itself with a number above those of the vocabulary.
    """

    def __init__(self, rank: dict[str, int], ids: dict[str, int], first_free: int):
        self.rank = rank
        self.texts: dict[int, str] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, number in ids.items():
            if merge_by_score(piece, rank) == [piece]:  # others can never come out of merging
                self._add(piece, number)
        singles = sorted({c for piece in ids for c in piece})
        for number, c in enumerate((c for c in singles if c not in ids), first_free):
            self._add(c, number)
        self.alphabet = frozenset(singles)
        self.automaton.make_automaton()
        self._compatible: dict[int, bool] = {}

    def _add(self, piece: str, number: int) -> None:
        self.texts[number] = piece
        self.automaton.add_word(piece, (len(piece), number))

    def _test(self, left: int, right: int, pair: int) -> bool:
        if len(self._compatible) >= MAX_PAIRS:
            self._compatible.clear()
        a, b = self.texts[left], self.texts[right]
        known = self._compatible[pair] = merge_by_score(a + b, self.rank) == [a, b]
        return known

    def last_pieces(self, text: str) -> list[int]:
        """For each prefix the last piece of its encoding; -1 for the empty one."""
        last, known, test = [-1] * (len(text) + 1), self._compatible, self._test
        for end, (length, piece) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if length < end:
                left = last[end - length]
                pair = left << 32 | piece
                fits = known.get(pair)
                if not (test(left, piece, pair) if fits is None else fits):
                    continue
            last[end] = piece
        return last

    def cut(self, text: str) -> list[int]:
        """Numbers of the pieces, found from the end of the text to its beginning."""
        last, at, found = self.last_pieces(text), len(text), []
        while at:
            piece = last[at]
            found.append(piece)
            at -= len(self.texts[piece])
        found.reverse()
        return found


def _one_mark_per_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_mark_per_byte", _one_mark_per_byte)


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, model: Model):
        self.model = model
        normal = {p: i for i, (p, kind) in enumerate(zip(model.pieces, model.kinds)) if kind == NORMAL}
        order = {s: i for i, s in enumerate(sorted({model.scores[i] for i in normal.values()}, reverse=True))}
        self.table = PrefixTable({p: order[model.scores[i]] for p, i in normal.items()}, normal, len(model.pieces))
        self._split = re.compile(safe_cuts(normal)).findall
        self._strange = re.compile(f"([^{re.escape(''.join(sorted(self.table.alphabet)))}])").split
        unknown = [i for i, kind in enumerate(model.kinds) if kind == UNKNOWN]
        self.unknown = unknown[0] if unknown else 0
        self.byte_ids = [0] * 256
        #: The bytes that each id stands for, alone.
        self.bytes: list[bytes] = []
        for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
            if kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
            data = bytes([int(piece[1:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else piece.replace(BLANK, " ").encode()
            self.bytes.append(model.unknown.encode() if kind == UNKNOWN else data)
        self._parts: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _without_piece(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()] if self.model.fallback else [self.unknown]

    def encode_part(self, part: str) -> list[int]:
        """Ids of a text between two safe cuts, by the prefix table."""
        vocabulary, found = len(self.model.pieces), []
        for i, known in enumerate([part] if self.table.alphabet.issuperset(part) else self._strange(part)):
            if i % 2:
                found += self._without_piece(known)
            elif known:
                for piece in self.table.cut(known):
                    found += [piece] if piece < vocabulary else self._without_piece(self.table.texts[piece])
        if self.model.fallback:
            return found
        return [p for i, p in enumerate(found) if p != self.unknown or not i or found[i - 1] != p]  # unknown ones run together

    def _part(self, part: str) -> tuple[int, ...]:
        ids = self._older.get(part) or tuple(self.encode_part(part))
        if len(part) <= MAX_PART:
            self._parts[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return self.encode_prefixed(" " + text if text and self.model.prefix else text)

    def encode_prefixed(self, text: str) -> list[int]:
        """Ids of a text that begins with the blank put before it, if the model puts one."""
        out: list[int] = []
        if len(self._parts) >= MAX_PARTS:  # parts in use come back from the older table
            self._parts, self._older = {}, self._parts
        known, missing = self._parts.get, self._part
        for part in self._split(text.replace(" ", BLANK)):
            out += known(part) or missing(part)
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        """The text in UTF-8 without the blank put before it; bytes that belong to no character become U+FFFD each."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        if self.model.prefix and data[:1] == b" ":
            first = next(i for i in ids if self.model.kinds[i] != CONTROL)
            if self.model.kinds[first] == NORMAL:
                data = data[1:]
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "one_mark_per_byte").encode()
        return data

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process, so parts met in one task serve the next."""
    return Codec(read_model(path))


def encode(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the piece ids of each whole text (null and empty texts: no ids)."""

    def make():
        own = codec(os.fspath(path))
        return lambda text: (own.encode((text or b"").decode("utf-8", "replace")),)

    return per_text(df, make, "ids ints", id_col=id_col, text_col=text_col)


def round_trip(
    df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Encode each whole text, decode the ids, and report digests of both.

    Columns doc_id, ``keep``, n_tokens, ids_sha256, decoded_sha256. Null counts as empty: no ids and the digests of nothing.
    Repeated rows, ids and null ids each give a row; an empty table gives an empty one; other columns of any name are
    passed over. A very long text is encoded in parts, one without a safe cut in a table of one number for each
    character. Nothing is shuffled.
    """

    def make():
        own = codec(os.fspath(path))
        name = [str(i) for i in range(len(own.bytes))].__getitem__

        def one(text: bytes | None) -> tuple:
            ids = own.encode((text or b"").decode("utf-8", "replace"))
            told = hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest()
            return len(ids), told, hashlib.sha256(own.decode_bytes(ids)).hexdigest()

        return one

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_text(df, make, schema, id_col=id_col, text_col=text_col, keep=keep)
