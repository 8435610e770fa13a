"""Greedy longest-match token counts in time linear in the text, without building the tokens.

The vocabulary is a trie with two roots: pieces that begin a word and pieces that go on inside one. Each node has a
failure link to the node where matching goes on when no child fits, and the number of tokens that are complete at
that point. Following links pops those tokens by their number only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame

from loadcycle.llm.bpe import read_ranks
from loadcycle.llm.common import per_text

MAX_WORDS = 300_000
_NONE = -1


class LongestMatch:
    """The automaton for word-initial and word-internal pieces."""

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        self.children: list[dict[int, int]] = [{}, {}]  # 0: start of a word, 1: inside a word
        self._token = [False, False]
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                self._add(root, piece)
        self.link = [_NONE] * len(self.children)
        self.popped = [0] * len(self.children)
        self._connect()

    def _add(self, node: int, piece: bytes) -> None:
        if not piece:
            return
        for byte in piece:
            nxt = self.children[node].get(byte)
            if nxt is None:
                nxt = self.children[node][byte] = len(self.children)
                self.children.append({})
                self._token.append(False)
            node = nxt
        self._token[node] = True

    def _connect(self) -> None:
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for byte, node in self.children[parent].items():
                queue.append(node)
                if self._token[node]:
                    self.link[node], self.popped[node] = 1, 1
                    continue
                at, popped = self.link[parent], self.popped[parent]
                while at != _NONE and byte not in self.children[at]:
                    popped += self.popped[at]
                    at = self.link[at]
                if at != _NONE:
                    self.link[node], self.popped[node] = self.children[at][byte], popped

    def count(self, word: bytes) -> int:
        """Tokens of one word; a word that the pieces cannot spell is one unknown token."""
        children, link, popped = self.children, self.link, self.popped
        node, tokens = 0, 0
        for byte in word:
            nxt = children[node].get(byte)
            while nxt is None:
                tokens += popped[node]
                node = link[node]
                if node == _NONE:
                    return 1
                nxt = children[node].get(byte)
            node = nxt
        while node > 1:
            tokens += popped[node]
            node = link[node]
            if node == _NONE:
                return 1
        return tokens


def pieces_of_ranks(path: str) -> tuple[set[bytes], set[bytes]]:
    """Word pieces from a byte-level rank file: tokens with a leading blank begin a word, those without go on in one.

    Every single byte is a piece in both places, so each word can be spelt.
    """
    ranks = read_ranks(path)
    single = {bytes([b]) for b in range(256)}
    initial = {t[1:] for t in ranks if t[:1] == b" " and len(t) > 1} | single
    return initial, {t for t in ranks if t[:1] != b" "} | single


@lru_cache(maxsize=2)
def automaton(path: str) -> LongestMatch:
    return LongestMatch(*pieces_of_ranks(path))


def token_counts(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens of each whole text; words are the runs between ``[\\x20\\x09-\\x0D]``.

    Null and empty texts and texts of white space only have no words and no tokens. Each row is counted by itself,
    so repeated rows and ids come out as they are; other columns, of any name, are passed over; an empty table gives an empty result.
    """

    def make():
        match, known = automaton(path), {}

        def one(text: bytes | None) -> tuple:
            if len(known) > MAX_WORDS:
                known.clear()
            words, tokens = (text or b"").split(), 0
            for word in words:
                n = known.get(word)
                if n is None:
                    n = match.count(word)
                    if len(word) <= 64:
                        known[word] = n
                tokens += n
            return len(words), tokens

        return one

    return per_text(df, make, "n_words long, n_tokens long", id_col=id_col, text_col=text_col)
