"""Byte-level BPE as a finite-state transducer, and streaming decoding.

A merge list cuts a byte string into one token sequence only, and a sequence is that cut exactly when every two
neighbours are the cut of their own bytes. So the cut can be followed from left to right: for each place that a
token may still begin at, keep the node of the vocabulary's trie reached from there and the tokens before it. That
set of alternatives is one state of a deterministic transducer. States and transitions are made when a text first
needs them and are kept for all later texts. A token is put out as soon as every alternative agrees on it, which
happens after a bounded number of bytes, as no alternative outlives the longest token. What a byte does to the trie nodes
of a state is worked out once for all states with these nodes (their shape); the last byte of a piece needs no state after it.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from loadcycle.llm.common import per_text

#: Transitions and pieces remembered per worker; beyond that the tables start anew, so memory stays bounded.
MAX_TRANSITIONS = 600_000
MAX_PIECES = 240_000
#: New objects between two collections of a worker's garbage. The tables make many objects and no cycles, and by Python's
#: own setting they would be walked through over and over.
YOUNG = 50_000
#: Places in the table of token pairs, a power of two. A pair overwrites the one that was in its place.
PAIR_PLACES = 1 << 19
#: Bytes at the beginning of a piece that are followed in one step once they have been met.
HEAD = 5
_NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: merge the neighbours of lowest rank, leftmost first, until none is in the vocabulary."""
    parts = [data[i : i + 1] for i in range(len(data))]
    for _ in merges(parts, ranks):
        pass
    return [ranks[p] for p in parts]


def merges(parts: list[bytes], ranks: dict[bytes, int]) -> Iterator[int]:
    """Merges the parts in place and yields the rank of each merge once it is done."""
    get = ranks.get
    merged = [get(left + right, _NEVER) for left, right in zip(parts, parts[1:])]
    while merged:
        low = min(merged)
        if low == _NEVER:
            break
        i = merged.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del merged[i]
        if i < len(merged):
            merged[i] = get(parts[i] + parts[i + 1], _NEVER)
        if i:
            merged[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
        yield low


#: The transitions of a state that has none yet.
_NOWHERE: dict[int, tuple[int, tuple[int, ...]]] = {}


class Transducer:
    """The lazily determinised transducer for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing[:5]}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._edges: dict[int, int] = {}  # the trie, by node and byte in one number
        self._grows = bytearray(1)  # whether a node has any edge
        self.token_at: list[int] = [-1]
        self._pairs = array("Q", bytes(8 * PAIR_PLACES))  # the pair and its answer in the lowest bit
        self._histories: dict[int, tuple[tuple, tuple, tuple]] = {}
        for token, rank in ranks.items():
            if merge_by_rank(token, ranks) == [rank]:  # others can never come out of merging
                self._add(token, rank)
        self._reset()

    def _add(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            nxt = self._edges.get(node << 8 | byte)
            if nxt is None:
                nxt = self._edges[node << 8 | byte] = len(self.token_at)
                self._grows[node] = 1
                self._grows.append(0)
                self.token_at.append(-1)
            node = nxt
        self.token_at[node] = rank

    def _reset(self) -> None:
        self._shapes: list[tuple[int, ...]] = []  # the alternatives' nodes in the trie, the root last
        self._shape_ids: dict[tuple[int, ...], int] = {}
        self._moves: dict[int, tuple[tuple, tuple[int, ...], int]] = {}  # by shape and byte
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._final: list[tuple[int, ...]] = []
        self._next: list[dict[int, tuple[int, tuple[int, ...]]]] = []  # by state, then by byte
        self._outs: dict[tuple[int, ...], tuple[int, ...]] = {}
        self._heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}  # by the first bytes of a piece
        self._made = 0
        self._state((self._shape((0,)), -1, ()))

    def _once(self, out: tuple[int, ...]) -> tuple[int, ...]:
        """One object for equal outputs."""
        return self._outs.setdefault(out, out)

    def _state(self, told: tuple) -> int:
        """The number of a state, which is told as its shape, the token before it and the tokens of each alternative."""
        found = self._ids.setdefault(told, len(self._states))
        if found == len(self._states):
            self._states.append(told)
            self._final.append(told[-1])
            self._next.append(_NOWHERE)
        return found

    def _shape(self, nodes: tuple[int, ...]) -> int:
        found = self._shape_ids.setdefault(nodes, len(self._shapes))
        if found == len(self._shapes):
            self._shapes.append(nodes)
        return found

    def _move(self, shape: int, byte: int) -> tuple[tuple, tuple[int, ...], int]:
        """What a byte does to all states of a shape: the tokens it ends, with the place of their alternative in a state, the
        places of the alternatives that go on, and the shape of these with the one that begins after the byte."""
        ends, stay, nodes = [], [], []
        for place, node in enumerate(self._shapes[shape], 2):
            node = self._edges.get(node << 8 | byte)
            if node is None:
                continue
            if self.token_at[node] >= 0:
                ends.append((place, self.token_at[node]))
            if self._grows[node]:
                stay.append(place)
                nodes.append(node)
        made = self._moves[shape << 8 | byte] = tuple(ends), tuple(stay), self._shape((*nodes, 0))
        self._made += 1
        return made

    def _whole(self, told: tuple, ends: tuple[tuple[int, int], ...]) -> tuple[int, ...]:
        """The tokens of a state with one more byte. Just one of the tokens that it may end fits its left neighbour, so the last needs no test."""
        for place, token in ends[:-1]:
            pending = told[place]
            left = pending[-1] if pending else told[1]
            if left < 0 or self._neighbours(left, token):
                return (*pending, token)
        place, token = ends[-1]
        return (*told[place], token)

    def _history(self, token: int) -> tuple[tuple, tuple, tuple]:
        """A token's merges from its bytes: their ranks in turn, then the first and the last part before each and at the end."""
        known = self._histories.get(token)
        if known is None:
            data, whole = self.tokens[token], self.tokens
            parts = [data[i : i + 1] for i in range(len(data))]
            ranks, firsts, lasts = [], [parts[0]], [parts[-1]]
            for rank in merges(parts, self.ranks):
                ranks.append(rank)
                firsts.append(whole[self.ranks[parts[0]]])  # one object for equal parts
                lasts.append(whole[self.ranks[parts[-1]]])
            known = self._histories[token] = (*ranks, _NEVER), tuple(firsts), tuple(lasts)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether two tokens, each the cut of its own bytes, are the cut of their bytes together.

        Until a merge joins them, each takes its own merges in their turn: the lower rank of the two first, on a tie the left one.
        """
        mine, _, lasts = self._history(left)
        yours, firsts, _ = self._history(right)
        i = j = 0
        while True:
            across = self.ranks.get(lasts[i] + firsts[j], _NEVER)
            end, begin = lasts[i], firsts[j]
            while lasts[i] is end and firsts[j] is begin:
                if across < mine[i] and across <= yours[j]:
                    return False
                if mine[i] <= yours[j]:
                    if mine[i] == _NEVER:
                        return True
                    i += 1
                else:
                    j += 1

    def _neighbours(self, left: int, right: int) -> bool:
        pair = (left + 1) << 32 | right  # never 0
        place = (pair * 0x9E3779B97F4A7C15 >> 40) & (PAIR_PLACES - 1)
        held = self._pairs[place]
        if held >> 1 == pair:
            return bool(held & 1)
        known = self._apart(left, right)
        self._pairs[place] = pair << 1 | known
        return known

    def _make(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        told, once, out = self._states[state], self._outs.setdefault, ()
        ends, stay, shape = self._moves.get(told[0] << 8 | byte) or self._move(told[0], byte)
        last, whole = told[1], self._whole(told, ends)
        alive = [told[place] for place in stay]
        if not alive:
            out, whole, last = whole, (), whole[-1]
        elif alive[0]:  # else an alternative still waits at the place told so far
            agreed = 0
            while all([pending[agreed : agreed + 1] == whole[agreed : agreed + 1] for pending in alive]):
                agreed += 1
            if agreed:
                out, whole = whole[:agreed], whole[agreed:]
                alive = [once(later, later) for later in [pending[agreed:] for pending in alive]]
            last = -1 if alive[0] else out[-1]
        made = self._state((shape, last, *alive, once(whole, whole))), once(out, out)
        known = self._next[state]
        if known is _NOWHERE:
            known = self._next[state] = {}
        known[byte] = made
        self._made += 1
        return made

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one match of the splitting pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if self._made > MAX_TRANSITIONS:
            self._reset()
        head = self._heads.get(piece[:HEAD])
        if head is None:
            state, out = self._follow(0, piece[:HEAD])
            head = self._heads[piece[:HEAD]] = state, self._once(tuple(out))
            self._made += 1
        state, out = head
        known, left = self._next, len(piece) - HEAD
        for byte in piece[HEAD:]:
            step = known[state].get(byte)
            left -= 1
            if step is None:
                if not left:
                    return out + self._end(state, byte)
                step = self._make(state, byte)
            state, ready = step
            if ready:
                out += ready
        return out + self._final[state]

    def _end(self, state: int, byte: int) -> tuple[int, ...]:
        """The last tokens of a piece that ends with a byte not met in this state: no other byte follows, so no state is made."""
        told = self._states[state]
        return self._whole(told, (self._moves.get(told[0] << 8 | byte) or self._move(told[0], byte))[0])

    def _follow(self, state: int, data: bytes) -> tuple[int, list[int]]:
        """The state after some bytes and the tokens put out on the way."""
        out, known = [], self._next
        for byte in data:
            step = known[state].get(byte)
            if step is None:
                step = self._make(state, byte)
            state, ready = step
            if ready:
                out.extend(ready)
        return state, out


class Utf8Stream:
    """Incremental UTF-8: whole characters come out, a character cut by the end of a chunk waits for the next one.

    The machine's state is the bytes of the unfinished character (three at the most). Bytes that cannot belong to
    any character come out as U+FFFD.
    """

    def __init__(self):
        self._held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that the end cuts."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                needs = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 0
                if needs <= back:
                    return 0
                if back > 1:  # the second byte has its own bounds after these leading bytes
                    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
                        byte, (0x80, 0xBF)
                    )
                    if not low <= data[1 - back] <= high:
                        return 0
                return back
        return 0

    def feed(self, chunk: bytes) -> str:
        data = self._held + chunk
        if data.isascii():
            self._held = b""
            return data.decode("ascii")
        back = self._unfinished(data)
        self._held = data[len(data) - back :]
        return data[: len(data) - back].decode("utf-8", "replace")

    def end(self) -> str:
        held, self._held = self._held, b""
        return held.decode("utf-8", "replace")


class _Pieces(dict):
    """Token ids by piece; a piece that is not there is looked for in the table before, or encoded."""

    def __init__(self, encode: Callable[[bytes], tuple[int, ...]]):
        super().__init__()
        self._encode, self._older = encode, {}

    def next(self) -> _Pieces:
        """An empty table with this one before it."""
        new = _Pieces(self._encode)
        new._older, self._older = self, {}
        return new

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self._older.get(piece) or self._encode(piece.encode())
        if len(ids) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """Splits, encodes and decodes whole texts."""

    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(read_ranks(path))
        self._split = regex.compile(pattern).findall
        self._pieces = _Pieces(self.transducer.encode_piece)

    def encode(self, text: str) -> list[int]:
        if len(self._pieces) >= MAX_PIECES:  # pieces in use come back from the older table
            self._pieces = self._pieces.next()
        return list(chain.from_iterable(map(self._pieces.__getitem__, self._split(text))))

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.transducer.tokens.__getitem__, ids))

    def decode_stream(self, ids: list[int], step: int = 4096) -> Iterator[str]:
        """The text in chunks of whole characters, from ``step`` ids at a time."""
        stream = Utf8Stream()
        for start in range(0, len(ids), step):
            yield stream.feed(self.decode_bytes(ids[start : start + step]))
        yield stream.end()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, so states made for one task serve the next."""
    gc.set_threshold(max(gc.get_threshold()[0], YOUNG), *gc.get_threshold()[1:])
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of each whole text (null and empty texts: no ids)."""

    def make():
        own = codec(os.fspath(path), pattern)
        return lambda text: (own.encode((text or b"").decode("utf-8", "replace")),)

    return per_text(df, make, "ids ints", id_col=id_col, text_col=text_col)


def round_trip(
    df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Encode each whole text, decode the ids as a stream, and report digests of both.

    Null counts as empty: no ids and the digests of nothing. Repeated rows each give a row; other columns, of any name, are passed
    over; an empty table gives an empty one. Nothing is shuffled.
    """

    def make():
        own = codec(os.fspath(path), pattern)
        names = {rank: str(rank) for rank in own.transducer.tokens}

        def one(text: bytes | None) -> tuple:
            ids = own.encode((text or b"").decode("utf-8", "replace"))
            decoded = hashlib.sha256()
            for chunk in own.decode_stream(ids):
                decoded.update(chunk.encode())
            told = hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest()
            return len(ids), told, decoded.hexdigest()

        return one

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_text(df, make, schema, id_col=id_col, text_col=text_col, keep=keep)
