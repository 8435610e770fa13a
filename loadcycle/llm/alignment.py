"""Alignment of the tokens that two tokenizers make of the same text.

Both sequences cover the same bytes. Places where a token of each ends cut them into groups: they are found as the
intersection of the cumulative ends, kept in dictionaries from end to index, and the sorted common ends slice both
sequences. Within a slice every two tokens whose bytes overlap are linked. The links of all texts are then counted by pair
of ids; the counts lie in sorted arrays in the shared folder, which the workers map to judge each text's links.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.llm import arrays
from loadcycle.llm.common import columns, cut, per_texts, scratch_path, to_arrow
from loadcycle.llm.sentence_pieces import BLANK, BYTE, read_model

#: Tokens of each side that are sliced at once. A slice that is longer makes its window grow, so nothing is cut.
WINDOW = 1024
#: Bytes of texts that are aligned together; a longer text is aligned alone.
TOGETHER = 300_000
#: Distinct pairs a task holds before it passes their counts on.
HELD = 1_000_000
#: Files of counts, over which B ids are dealt by their remainder. One holds at most the pairs of its share of the B ids with all A
#: ids, whatever the size of the corpus.
FILES = 256


# Tokens and their bytes ----------------------------------------------------------------------

def _byte_level() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Tokenizer:
    """Ids of a text, and the bytes of each id.

    ``exact`` if the bytes of the ids are those of the text by construction, but for texts with one of the characters ``unless``.
    """

    encode: Callable[[str], list[int]]
    bytes: list[bytes]
    exact: bool = False
    unless: str = ""

    def gives(self, ids: list[int], text: str) -> bool:
        """Whether the bytes of the ids are those of the text."""
        if self.exact and not any(c in text for c in self.unless):
            return True
        return b"".join(map(self.bytes.__getitem__, ids)) == text.encode()


@lru_cache(maxsize=2)
def byte_level_tokenizer(path: str, pattern: str) -> Tokenizer:
    """A byte-level merge vocabulary in a JSON file whose ids follow the order of its merges.

    Special tokens are not known to it, so their strings in a text are plain text.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    table = _byte_level()
    ids = {bytes(table[c] for c in token): number for token, number in model["vocab"].items()}
    joined = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if joined != sorted(joined):
        raise ValueError("the ids do not follow the order of the merges")
    own = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ids, special_tokens={})
    tokens = [b""] * (max(ids.values()) + 1)
    for token, number in ids.items():
        tokens[number] = token
    return Tokenizer(own.encode_ordinary, tokens, exact=True)


@lru_cache(maxsize=2)
def piece_tokenizer(path: str) -> Tokenizer:
    """A SentencePiece model, without begin and end ids; the bytes include the blank it puts before a text."""
    own, model = sentencepiece.SentencePieceProcessor(model_file=path), read_model(path)
    tokens = [
        bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(BLANK, " ").encode() for p, kind in zip(model.pieces, model.kinds)
    ]
    # the model leaves texts as they are, and has the bytes of every character; only its own sign for a blank reads as one
    return Tokenizer(lambda text: own.encode(text, num_threads=1), tokens, model.fallback and model.prefix, BLANK)


# Texts by themselves ------------------------------------------------------------------------

def common_ends(sizes_a: list[int], sizes_b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of each side end at or before each common end, in order.

    Ends grow, so the keys of a dictionary are sorted as they were put in, and so are those that both have.
    """
    at_a = dict(zip(accumulate(sizes_a), range(1, len(sizes_a) + 1)))
    at_b = dict(zip(accumulate(sizes_b), range(1, len(sizes_b) + 1)))
    ends = list(filter(at_b.__contains__, at_a))
    return list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))


def slices(sizes_a: list[int], sizes_b: list[int], window: int) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side lie in or before each group. The sizes of both sides have the same sum.

    The ends of a window of both sides are intersected up to their last common end, where the next window begins.
    """
    i, j, wide, found_a, found_b = 0, 0, window, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while i < len(sizes_a):
        a, b = common_ends(sizes_a[i : i + wide], sizes_b[j : j + wide])
        if not a:  # one group is longer than the window
            wide *= 2
            continue
        found_a.append(np.array(a, np.int64) + i)
        found_b.append(np.array(b, np.int64) + j)
        i, j, wide = i + a[-1], j + b[-1], window
    return np.concatenate(found_a), np.concatenate(found_b)


def links(sizes_a: np.ndarray, sizes_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all A and B tokens that are linked.

    A slice with one token on a side links it to all of the other side. In the others each stretch between two
    neighbouring ends belongs to one token of each side, and those two are linked.
    """
    many_a, many_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    of_a, of_b = np.repeat(np.arange(len(ends_a)), many_a), np.repeat(np.arange(len(ends_b)), many_b)
    one_a = np.flatnonzero(many_a[of_b] == 1)
    one_b = np.flatnonzero((many_a[of_a] > 1) & (many_b[of_a] == 1))
    found_a, found_b = [ends_a[of_b[one_a]] - 1, one_b], [one_a, ends_b[of_a[one_b]] - 1]
    rest = (many_a > 1) & (many_b > 1)
    if rest.any():
        rest_a, rest_b = np.flatnonzero(rest[of_a]), np.flatnonzero(rest[of_b])
        stop_a, stop_b = np.cumsum(sizes_a)[rest_a], np.cumsum(sizes_b)[rest_b]
        stops = np.union1d(stop_a, stop_b)
        found_a.append(rest_a[np.searchsorted(stop_a, stops)])
        found_b.append(rest_b[np.searchsorted(stop_b, stops)])
    return np.concatenate(found_a), np.concatenate(found_b)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of all parts and their summed counts."""
    keys, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


class Aligner:
    """Aligns texts under two tokenizers."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self._sizes_a, self._sizes_b = (np.array([len(t) for t in x.bytes]) for x in (a, b))
        inner = [f"{i}," for i in range(max(len(a.bytes), len(b.bytes)))]
        #: Names in the digest: inside a group, at the end of its A ids, at its end, at the end of a text.
        self._names = [*inner, *[n[:-1] + "|" for n in inner], *[n[:-1] + ";" for n in inner], *[n[:-1] for n in inner]]

    def tokens(self, text: bytes | None) -> tuple[list[int], list[int]]:
        """Ids of a blank and the text under A, and of the text under B; none where either does not give these bytes."""
        if not text:
            return [], []
        plain = text.decode("utf-8", "replace")
        ids_a, ids_b = self.a.encode(" " + plain), self.b.encode(plain)
        for ids, tokenizer in ((ids_a, self.a), (ids_b, self.b)):
            if not tokenizer.gives(ids, " " + plain):
                return [], []
        return ids_a, ids_b

    def align(self, texts: list[bytes | None]) -> list[tuple]:
        """For each text: tokens of both sides, groups and links as numbers, the groups' digest, the linked pairs.

        The texts are aligned as one sequence, in which each of them ends at a common end.
        """
        ids = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        a, b = (np.fromiter(chain.from_iterable(x[side] for x in ids), np.int64, n.sum()) for side, n in ((0, n_a), (1, n_b)))
        sizes_a, sizes_b = self._sizes_a[a], self._sizes_b[b]
        ends_a, ends_b = slices(sizes_a.tolist(), sizes_b.tolist(), WINDOW)
        stops_a = np.cumsum(n_a)
        n_groups = np.bincount(np.searchsorted(stops_a, ends_a), minlength=len(texts))
        told = self._told(a, b, ends_a, ends_b, stops_a[n_a > 0])
        place_a, place_b = links(sizes_a, sizes_b, ends_a, ends_b)
        base = len(self.a.bytes)
        pair, text = b[place_b] * base + a[place_a], np.repeat(np.arange(len(texts)), n_a)[place_a]
        each = len(self.b.bytes) * base
        keys, counts = _summed([(text * each + pair, np.ones(len(pair), np.int64))])
        cuts = np.searchsorted(keys, np.arange(len(texts) + 1) * each)
        pair = keys % each
        keys = pair // base << 32 | pair % base
        n_links, at, rows = np.bincount(text, minlength=len(texts)), 0, []
        for i in range(len(texts)):
            stop = at + int(n_a[i] + n_b[i])
            digest = hashlib.sha256("".join(told[at:stop]).encode()).hexdigest() if n_a[i] else ""
            own = slice(cuts[i], cuts[i + 1])
            rows.append((int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), digest, _packed(keys[own], counts[own])))
            at = stop
        return rows

    def _told(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray) -> list[str]:
        """Group after group its A ids and its B ids, as told in the digest."""
        step = len(self._names) // 4
        name_a, name_b = a.copy(), b.copy()
        name_a[ends_a - 1] += step
        name_b[ends_b - 1] += 2 * step
        name_b[ends_b[np.searchsorted(ends_a, stops_a)] - 1] += step
        many_a, many_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(ends_b - many_b, many_a)] = name_a
        order[np.arange(len(b)) + np.repeat(ends_a, many_b)] = name_b
        return list(map(self._names.__getitem__, order.tolist()))


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs by their steps, and their counts."""
    steps = np.diff(keys, prepend=0).astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(steps + counts.astype("<i8").tobytes())


def _pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (the B id in the upper half, the A id in the lower) and counts."""
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i8").reshape(2, -1)
    return np.cumsum(both[0]), both[1]


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"


def align(
    df: DataFrame, make: Callable[[], Aligner], *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Each whole text aligned by itself: doc_id, ``keep``, the numbers, the groups' digest and the linked pairs.

    ``pairs`` holds a text's distinct linked id pairs and how often each is linked, packed.
    """
    return per_texts(df, lambda: make().align, _ALIGNED, TOGETHER, id_col=id_col, text_col=text_col, keep=keep)


# All texts ----------------------------------------------------------------------------------

_SUMS = columns("b int, a int, times long")


def link_counts(aligned: DataFrame) -> DataFrame:
    """b, a, times and ``best`` of every id pair that any text links: best if no pair with that B id is linked more often.

    Each task sums the pairs of its texts before the shuffle. A B id has no more pairs than there are A ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, size = to_arrow(_SUMS), [], 0

        def out():
            keys, sums = _summed(held)
            return pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype("<i4")), pa.array((keys & 0xFFFFFFFF).astype("<i4")), pa.array(sums)], schema=schema)

        for batch in batches:
            for packed in batch.column(0):
                held.append(_pairs(packed.as_py()))
                size += len(held[-1][0])
                if size > HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    sums = aligned.select("pairs").mapInArrow(run, _SUMS)
    totals = sums.groupBy("b", "a").agg(F.sum("times").alias("times"))
    most = F.max("times").over(Window.partitionBy("b"))
    return totals.withColumn("best", F.col("times") == most)


def save_counts(counts: DataFrame) -> str:
    """Writes the counts as sorted arrays in ``FILES`` files, and gives the folder."""
    folder = scratch_path(counts.sparkSession, "links")
    marked = counts.withColumn("file", (F.col("b") % FILES).cast("long"))
    done = columns("file long, size long")

    def write(table: pa.Table) -> pa.Table:
        keys = table["b"].to_numpy().astype(np.int64) << 32 | table["a"].to_numpy()
        order = np.argsort(keys)
        file = table["file"][0].as_py()
        arrays.save(folder, str(file), {
            "keys": keys[order], "times": table["times"].to_numpy()[order], "best": table["best"].to_numpy(zero_copy_only=False)[order],
        })
        return pa.table({"file": [file], "size": [len(keys)]}, schema=to_arrow(done))

    cut(marked.groupBy("file").applyInArrow(write, done), "links-written")
    return folder


def judged(aligned: DataFrame, folder: str) -> DataFrame:
    """The aligned texts with n_best and count_sum, looked up in the written counts; no row leaves its partition."""
    told = [c for c in aligned.columns if c != "pairs"]
    source = aligned.select(*told, "pairs")
    out = T.StructType([*source.schema.fields[:-1], *columns("n_best long, count_sum long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow(out)
        for batch in batches:
            texts = [_pairs(p.as_py()) for p in batch.column(len(told))]
            number = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
            keys = np.concatenate([np.empty(0, np.int64), *[t[0] for t in texts]])
            times = np.concatenate([np.empty(0, np.int64), *[t[1] for t in texts]])
            total, best = _looked_up(folder, keys)
            n_best, count_sum = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            np.add.at(n_best, number, times * best)
            np.add.at(count_sum, number, times * total)
            held = [batch.column(i).cast(schema.field(i).type) for i in range(len(told))]
            yield pa.RecordBatch.from_arrays([*held, pa.array(n_best), pa.array(count_sum)], schema=schema)

    return source.mapInArrow(run, out)


def _looked_up(folder: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and best marks of pairs."""
    own, back = np.unique(keys, return_inverse=True)
    total, best = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
    file = (own >> 32) % FILES
    order = np.argsort(file, kind="stable")  # keys stay sorted in each file
    starts = np.flatnonzero(np.diff(file[order], prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(own)]):
        mine = order[start:stop]
        known = arrays.mapped(folder, str(file[mine[0]]))
        at = np.searchsorted(known["keys"], own[mine])
        total[mine], best[mine] = known["times"][at], known["best"][at]
    return total[back], best[back]


def align_corpus(
    df: DataFrame, path_a: str, pattern_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the alignment of its tokens, judged by the links of the whole corpus.

    Columns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Null and empty texts, and texts whose
    tokens do not give a blank and the text byte for byte, have no tokens: zeros and an empty digest. Repeated rows and null ids each
    give a row and count each; an empty table gives an empty one; other columns of any name are passed over. Very long texts are
    sliced by windows of tokens. Texts move in no shuffle; the alignments are written once, and read for the counts and to be judged.
    """

    def make() -> Aligner:
        return _aligner(path_a, pattern_a, path_b)

    aligned = cut(align(df, make, id_col=id_col, text_col=text_col), "aligned")
    found = judged(aligned, save_counts(link_counts(aligned)))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@lru_cache(maxsize=2)
def _aligner(path_a: str, pattern_a: str, path_b: str) -> Aligner:
    return Aligner(byte_level_tokenizer(path_a, pattern_a), piece_tokenizer(path_b))
