"""An interpolated modified Kneser-Ney model: counted in Spark, kept as sorted hash arrays, mapped into workers' memory.

Counting packs sorted runs of n-grams, as numbers of words, per task and deals them by the word right before the token
over shards whose number grows with the corpus; all shorter n-grams of such a shard are its own and need no shuffle. A
frequent word's n-grams are dealt by the whole context instead, and by the token where all of the context is frequent,
over as many shards as its count asks for. Each shard writes its sorted arrays into the shared folder. Workers map these files
and look up sorted batches of n-grams; nothing of the model passes through the driver but a few sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.llm import arrays
from loadcycle.llm.common import columns, cut, scratch_path, to_arrow

#: Tokens counted before a task packs them, and tokens for which there is one shard.
RUN, SHARD = 1_500_000, 3_000_000
#: Bytes of text for which there is one shard of words at the least.
WORD_BYTES = 1 << 26
#: A word is hot if it has more than one in so many of a shard's tokens, and is dealt over a shard for each such piece.
PIECES = 8
#: From so many keys on, their upper bytes are not written.
MANY = 1 << 18
_BEGIN, _END = np.uint64(0x5BD1E995A3C59AC3), np.uint64(0xC6A4A7935BD1E995)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in their order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def numbered(texts: list[bytes | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words, in order; the words of all texts, begins included, by their places among these;
    the tokens' places; their text numbers.

    A word is hashed once however often it comes.
    """
    pool = pa.system_memory_pool()  # Arrow's own pool would keep what is freed
    held = pa.array([text or b"" for text in texts], pa.large_binary(), memory_pool=pool)
    held = pc.ascii_lower(held.view(pa.large_string()), memory_pool=pool)  # bytes as they are, UTF-8 or not
    held = pc.ascii_split_whitespace(held, memory_pool=pool)
    words, sizes = held.values, np.diff(held.offsets.to_numpy())
    del held
    some = pc.greater(pc.binary_length(words, memory_pool=pool), 0).to_numpy(zero_copy_only=False)
    if not some.all():  # white space at an end
        sizes = np.bincount(np.repeat(np.arange(len(texts)), sizes)[some], minlength=len(texts))
        words = pc.filter(words, pa.array(some), memory_pool=pool)
    coded = pc.dictionary_encode(words, memory_pool=pool)
    del words, some
    _, at, data = coded.dictionary.buffers()
    at, data = np.frombuffer(at, np.int64)[: len(coded.dictionary) + 1].tolist(), memoryview(data or b"")
    hashes = np.empty(len(at) + 1, np.uint64)
    hashes[:2] = _BEGIN, _END
    hashes[2:] = np.fromiter(map(xxhash.xxh64_intdigest, map(data.__getitem__, map(slice, at, at[1:]))), np.uint64, len(at) - 1)
    del at, data
    own, to = np.unique(hashes, return_inverse=True)
    number = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(number)) + (number + 1) * (order - 1)
    inner = np.ones(len(number), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    flat = np.full(len(number) + len(texts) * (order - 1), to[0])
    flat[place] = to[1]
    flat[place[inner]] = to[2:][coded.indices.to_numpy()]
    return own, flat, place, number


def hashed(near: np.ndarray) -> np.ndarray:
    """Column j hashes the j + 1 nearest words of the context."""
    contexts = near.copy(order="K")
    for j in range(1, near.shape[1]):
        contexts[:, j] = mix(contexts[:, j - 1], near[:, j])
    return contexts


def marked(words: np.ndarray, hot: np.ndarray, spreads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are hot, and over how many shards each word's contexts may be dealt."""
    common, spread = is_in(words, hot), np.ones(len(words), np.int64)
    spread[common] = spreads[np.searchsorted(hot, words[common])]
    return common, spread


def shard_of(
    last: np.ndarray, contexts: np.ndarray, words: np.ndarray, common: np.ndarray, spread: np.ndarray, shards: int
) -> tuple[np.ndarray, np.ndarray]:
    """Where the shards of n-grams' contexts begin, and the shards of the n-grams.

    By the word right before the token (``last``), so that all shorter n-grams made of a shard's n-grams are its own. Where that
    word is hot (``common``), by the whole context, and by the token too if all its words are; these shards come after the
    others. A context is dealt over as many shards (``spread``) as its rarest word, since it is no more frequent than that.
    """
    base = (np.where(common, contexts, last) >> np.uint64(20)) % np.uint64(shards)
    shard, many = base.astype(np.int64), np.flatnonzero(spread > 1)
    salt = (words[many] >> np.uint64(40)) % spread[many].astype(np.uint64)
    shard[many] = (base[many] + salt) % np.uint64(shards)
    shard[common] += shards
    return base.astype(np.int64), shard


def by_shard(shard: np.ndarray) -> np.ndarray:
    """The stable order of the shards; few shards are sorted as short numbers, which is far quicker."""
    return np.argsort(shard.astype(np.uint16) if shard.max(initial=0) < 1 << 16 else shard, kind="stable")


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows change."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    change = np.zeros(len(columns[0]), bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def combine(near: np.ndarray, words: np.ndarray, counts: np.ndarray):
    """Sorted distinct n-grams and their summed counts."""
    columns = (*near.T, words)
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if max(bits) + len(words).bit_length() <= 64:
        key, wide = np.zeros(len(words), np.uint64), 0
        for c, more in zip(columns, bits):
            if wide + more > 64:  # the columns so far as one number
                order = np.argsort(key)
                starts = run_starts(key[order])
                number = np.zeros(len(key), np.uint64)
                number[starts[1:]] = 1
                key[order], wide = np.cumsum(number), len(starts).bit_length()
            key, wide = key << np.uint64(more) | c.astype(np.uint64), wide + more
        order = np.argsort(key)
        starts = run_starts(key[order])
    else:
        order = np.lexsort((words, *near.T[::-1]))
        starts = run_starts(*near[order].T, words[order])
    at, counts = order[starts], counts[order]
    return near[at], words[at], np.add.reduceat(counts, starts) if len(starts) else counts


def combine_words(words: np.ndarray, counts: np.ndarray):
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    starts = run_starts(words)
    return words[starts], np.add.reduceat(counts, starts) if len(starts) else counts


#: N-grams of one shard as numbers of words: the columns of the contexts, the tokens and the counts, each packed.
_GRAMS = columns("kind string, shard long, size long, near binary, words binary, counts binary")


def _pack(values: np.ndarray, step: bool = False) -> bytes:
    """Compressed planes of the bytes of a column, or of its steps."""
    wide = 4 if not len(values) or values.max() < 1 << 32 else 8
    values = values.astype(f"<u{wide}")
    if step and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))  # wraps round
    return bytes([wide]) + zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, wide).T.tobytes())


def _unpack(data: bytes, size: int, step: bool = False) -> np.ndarray:
    wide = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(wide, size)
    values = np.ascontiguousarray(planes.T).view(f"<u{wide}").reshape(size)
    return np.cumsum(values, dtype=values.dtype) if step else values


def _packed(kind: str, shard: int, near: np.ndarray | None, words: np.ndarray, counts: np.ndarray) -> tuple:
    parts = [] if near is None else [_pack(c, step=True) for c in near.T]
    held = b"".join(len(p).to_bytes(4, "little") + p for p in parts)
    return kind, shard, len(words), held, _pack(words, step=near is None), _pack(counts)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size, held, near, at = row["size"], row["near"], [], 0
    while at < len(held):
        end = at + 4 + int.from_bytes(held[at : at + 4], "little")
        near.append(_unpack(held[at + 4 : end], size, step=True))
        at = end
    words = _unpack(row["words"], size, step=not near)
    return np.column_stack(near) if near else np.empty((size, 0), "<u4"), words, _unpack(row["counts"], size).astype(np.int64)


def _table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    arrow = to_arrow(schema)
    columns = list(zip(*rows)) or [()] * len(arrow)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _by_shard(kind: str, shard: np.ndarray, near, words, counts) -> list[tuple]:
    """Rows sorted within shards, packed."""
    order = by_shard(shard)
    starts = run_starts(shard[order])
    rows = []
    for s, e in zip(starts, np.append(starts[1:], len(order))):
        at = order[s:e]
        rows.append(_packed(kind, int(shard[at[0]]), None if near is None else near[at], words[at], counts[at]))
    return rows


def _runs(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple]:
    """The numbered words of a task's texts, some RUN tokens at a time."""
    held, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            held.append(text.as_py())
            size += 16 + len(held[-1] or b"") // 6
            if size >= RUN:
                yield numbered(held, order)
                held, size = [], 0
    if held:
        yield numbered(held, order)


# Arrays of a shard --------------------------------------------------------------------------

def _packed_keys(name: str, keys: np.ndarray) -> dict[str, np.ndarray]:
    """Sorted keys; of many keys the two upper bytes are kept only as the places where they change."""
    if len(keys) < MANY:
        return {name: keys}
    tops = np.searchsorted(keys, np.arange(1, 1 << 16, dtype=np.uint64) << np.uint64(48))
    return {
        f"{name}-low": (keys & np.uint64(0xFFFF)).astype("<u2"), f"{name}-middle": (keys >> np.uint64(16)).astype("<u4"),
        name: np.concatenate(([0], tops, [len(keys)])).astype("<i8"),  # signed: not keys
    }


def _find(arrays_of: dict[str, np.ndarray], name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are there, and their places."""
    known = arrays_of[name]
    if known.dtype == np.uint64:
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.searchsorted(known, keys)
        at[at == len(known)] = 0
        return known[at] == keys, at
    low, middle = arrays_of[f"{name}-low"], arrays_of[f"{name}-middle"]
    top = (keys >> np.uint64(48)).astype(np.int64)
    at, stop = known[top], known[top + 1]
    want, rest = (keys >> np.uint64(16)).astype("<u4"), (keys & np.uint64(0xFFFF)).astype("<u2")
    step = 1 << int((stop - at).max(initial=0)).bit_length()
    while step := step >> 1:  # every key before ``at`` has a smaller middle
        ahead = at + step
        less = middle.take(ahead - 1, mode="clip") < want
        less &= ahead <= stop
        at += step * less
    while True:
        found = np.minimum(at, len(low) - 1)
        same = (at < stop) & (middle[found] == want)
        short = same & (low[found] < rest)
        if not short.any():
            return same & (low[found] == rest), found
        at += short


def _packed_counts(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Rows of counts of which the first is the largest, a byte each; rows with a larger one lie apart."""
    large = np.flatnonzero(counts[:, 0] >= 255)
    return {f"{name}-large": np.column_stack((large, counts[large])).astype("<i8"), name: np.minimum(counts, 255).astype("<u1")}


def _counts(arrays_of: dict[str, np.ndarray], name: str, at: np.ndarray) -> np.ndarray:
    rows = arrays_of[name][at].astype(np.int64)
    large = np.flatnonzero(rows[:, 0] == 255)
    if len(large):
        apart = arrays_of[f"{name}-large"]
        rows[large] = apart[np.searchsorted(apart[:, 0], at[large]), 1:]
    return rows


# Training -----------------------------------------------------------------------------------

@dataclass
class Model:
    """Where the arrays are, and the sums that every worker needs."""

    order: int
    folder: str
    shards: int
    word_shards: int
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    spreads: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    tokens: int = 0
    types: int = 0
    continuations: int = 0
    count_of_counts: dict[int, list[int]] = field(default_factory=dict)

    @property
    def files(self) -> int:
        """More than the highest number of a shard of any level."""
        return max(2 * self.shards, self.word_shards)

    def discounts(self, level: int) -> np.ndarray:
        """What is taken off a count of 0, 1, 2 and 3 or more."""
        n1, n2, n3, n4 = self.count_of_counts.get(level, [0, 0, 0, 0])
        if min(n1, n2, n3, n4) > 0:
            y = n1 / (n1 + 2 * n2)
            d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
            if (d[1:] > 0).all() and (d[1:] <= [1, 2, 3]).all():
                return d
        return np.array([0.0, 0.5, 1.0, 1.5])  # too few counts to estimate from


def _sums(rows: DataFrame) -> list:
    return rows.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "total")]).collect()


_STATS = columns("kind string, n1 long, n2 long, n3 long, n4 long, total long")


def _stats(kind: str, counts: np.ndarray) -> tuple:
    return kind, *(int((counts == i).sum()) for i in (1, 2, 3, 4)), int(counts.sum())


_REDUCED = T.StructType([*_GRAMS.fields, *_STATS.fields[1:]])


def word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes, so that words numbered shard by shard are in the order of their hashes."""
    return (((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Numbers:
    """Words as numbers: 0 begins a text, the others follow shard by shard in the order of their hashes."""

    def __init__(self, folder: str, sizes: np.ndarray):
        self._folder, self.first = folder, np.concatenate(([1], 1 + np.cumsum(sizes)))

    def _each(self, shard: np.ndarray):
        order = by_shard(shard)
        starts = run_starts(shard[order])
        for s, e in zip(starts, np.append(starts[1:], len(order))):
            number = int(shard[order[s]])
            yield order[s:e], self.first[number], arrays.mapped(self._folder, f"words-{number}")["keys"]

    def of(self, words: np.ndarray) -> np.ndarray:
        """Numbers of words of the corpus."""
        numbers, known = np.zeros(len(words), np.int64), np.flatnonzero(words != _BEGIN)
        for at, first, keys in self._each(word_shard(words[known], len(self.first) - 1)):
            numbers[known[at]] = first + np.searchsorted(keys, words[known[at]])
        return numbers

    def words(self, numbers: np.ndarray) -> np.ndarray:
        words, known = np.full(len(numbers), _BEGIN), np.flatnonzero(numbers)
        for at, first, keys in self._each(np.searchsorted(self.first, numbers[known], side="right") - 1):
            words[known[at]] = keys[numbers[known[at]].astype(np.int64) - first]
        return words


def train(df: DataFrame, *, order: int = 2, text_col: str = "text") -> Model:
    """Count the rows of ``df`` and write the model.

    Null texts are empty ones; each text counts its words and one end token. Lower orders count the distinct words
    to the left of an n-gram instead of its occurrences. Without any row the model gives every token the same chance.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = df.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    texts = df.select(F.col(text_col).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    deal = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // WORD_BYTES))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, flat, place, _ in _runs(batches, 2):
            counts = np.bincount(flat[place], minlength=len(own))
            words, counts = own[counts > 0], counts[counts > 0]
            shard = word_shard(words, deal)
            yield from _table(_by_shard("word", shard, None, words, counts), _GRAMS).to_batches()

    def join_words(table: pa.Table) -> pa.Table:
        rows = [_unpacked(r) for r in table.to_pylist()]
        words, counts = combine_words(np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]))
        packed = _packed("word", table["shard"][0].as_py(), None, words, counts)
        arrays.save(folder, f"words-{packed[1]}", {"keys": words})
        return _table([(*packed, len(words), 0, 0, 0, int(counts.sum()))], _REDUCED)

    vocabulary = cut(
        texts.mapInArrow(count_words, _GRAMS).groupBy("shard").applyInArrow(join_words, _REDUCED), "words"
    )
    sizes = np.zeros(deal, np.int64)
    tokens = 0
    for row in vocabulary.select("shard", "n1", "total").collect():  # a row per shard
        sizes[row["shard"]] = row["n1"]
        tokens += row["total"]
    types = int(sizes.sum())
    shards, piece = max(1, -(-tokens // SHARD)), max(1, SHARD // PIECES)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, words, counts = _unpacked(row)
                some = counts > piece
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[some].astype(np.uint64).view(np.int64)), pa.array(counts[some])], names=["word", "count"]
                )

    found = vocabulary.mapInArrow(frequent, "word long, count long").collect()  # fewer than PIECES words for each shard
    often = {int(np.int64(r["word"]).view(np.uint64)): r["count"] for r in found}
    often[int(_BEGIN)] = often.get(int(_END), 1)  # each text begins as often as it ends
    hot = np.array(sorted(often), np.uint64)
    spreads = np.array([min(shards, -(-often[w] // piece)) for w in sorted(often)], np.int64)
    model, numbers = Model(order, folder, shards, deal, hot, spreads, tokens, types), Numbers(folder, sizes)

    def dealt(own: np.ndarray, near: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Shards of n-grams of words that are given by their places in ``own``."""
        common, spread = marked(own, hot, spreads)
        least = np.min([spread[c] for c in near.T], axis=0)
        return shard_of(own[near[:, 0]], hashed(own[near])[:, -1], own[words], common[near[:, 0]], least, shards)[1]

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, flat, place, _ in _runs(batches, order):
            flat = flat.astype("<u4")
            near = np.column_stack([flat[place - 1 - j] for j in range(order - 1)])
            near, words, counts = combine(near, flat[place], np.ones(len(place), np.int64))
            shard, number = dealt(own, near, words), numbers.of(own)
            yield from _table(_by_shard(f"level{order}", shard, number[near], number[words], counts), _GRAMS).to_batches()

    def reduce_level(top: int):
        def write(level: int, shard: int, near, words, counts) -> list[tuple]:
            """Writes a level's arrays and those of the shorter n-grams that are of this shard; the others go on."""
            starts = run_starts(*near.T)
            lengths = np.diff(np.append(starts, len(words)))
            before = np.column_stack([numbers.words(c) for c in near[starts].T])
            contexts = hashed(before)[:, -1]
            own = np.column_stack(
                [np.add.reduceat(v, starts) for v in (counts, counts == 1, counts == 2, counts >= 3)]
            ).astype(np.int64)
            keys = mix(np.repeat(contexts, lengths), numbers.words(words))
            by_key, by_context = np.argsort(keys), np.argsort(contexts)
            arrays.save(folder, f"{level}-{shard}", {
                **_packed_keys("keys", keys[by_key]), **_packed_counts("counts", counts[by_key, None]),
                **_packed_keys("contexts", contexts[by_context]), **_packed_counts("totals", own[by_context]),
            })
            out = [(*_packed(f"stats{level}", shard, None, words[:0], counts[:0]), *_stats("", counts)[1:])]
            # each distinct n-gram is one word to the left of the shorter n-gram
            ones = np.ones(len(words), np.int64)
            if level == 2:
                less, n = combine_words(words, ones)
                to = np.searchsorted(numbers.first, less, side="right") - 1
                return out + [(*m, 0, 0, 0, 0, 0) for m in _by_shard("left", to, None, less, n)]
            near, words, counts = combine(near[:, :-1], words, ones)
            if shard < shards:
                return out + write(level - 1, shard, near, words, counts)
            some, at = np.unique(np.column_stack((near, words)), return_inverse=True)
            at = at.reshape(len(words), level - 1)
            to = dealt(numbers.words(some), at[:, :-1], at[:, -1])
            return out + [(*m, 0, 0, 0, 0, 0) for m in _by_shard(f"level{level - 1}", to, near, words, counts)]

        def run(table: pa.Table) -> pa.Table:
            rows = [_unpacked(r) for r in table.to_pylist()]
            grams = combine(*(np.concatenate([r[i] for r in rows]) for i in range(3)))
            return _table(write(top, table["shard"][0].as_py(), *grams), _REDUCED)

        return run

    grams, lefts_of = texts.mapInArrow(count_grams, _GRAMS), []
    for level in range(order, 1, -1):
        done = cut(grams.groupBy("shard").applyInArrow(reduce_level(level), _REDUCED), f"level{level}")
        for row in _sums(done.filter(F.col("kind").startswith("stats"))):
            known = model.count_of_counts.setdefault(int(row["kind"][5:]), [0, 0, 0, 0])
            for i in range(4):
                known[i] += row[f"n{i + 1}"]
        grams = done.filter(F.col("kind") == f"level{level - 1}").select(*_GRAMS.fieldNames())
        lefts_of.append(done.filter("kind = 'left'").select(*_GRAMS.fieldNames()))

    def join_left(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        rows = [(r["kind"], *_unpacked(r)[1:]) for r in table.to_pylist()]
        words, counts = combine_words(*(np.concatenate([r[i] for r in rows if r[0] == "word"]) for i in (1, 2)))
        left, n = combine_words(*(np.concatenate([np.empty(0, np.int64), *[r[i].astype(np.int64) for r in rows if r[0] == "left"]]) for i in (1, 2)))
        lefts = np.zeros(len(words), np.int64)
        lefts[left - numbers.first[shard]] = n
        arrays.save(folder, f"1-{shard}", {"keys": words, "counts": np.column_stack((counts, lefts))})
        return _table([("stats1", *_stats("", lefts)[1:])], _STATS)

    both = vocabulary.select(*_GRAMS.fieldNames())
    for lefts in lefts_of:
        both = both.unionByName(lefts)
    for row in _sums(cut(both.groupBy("shard").applyInArrow(join_left, _STATS), "level1")):
        model.count_of_counts[1] = [row[f"n{i}"] for i in (1, 2, 3, 4)]
        model.continuations = row["total"]
    return model


# Scoring ------------------------------------------------------------------------------------

def _look_up(model: Model, level: int, shard: np.ndarray, keys: np.ndarray, index: str, values: str, width: int) -> np.ndarray:
    """Rows of the values at the keys, 0 where a key is not there. Sorted keys are looked up in order in each shard."""
    rows, found = np.zeros((len(keys), width), np.int64), np.empty((len(keys), width), np.int64)
    order = by_shard(shard)
    shard, keys = shard[order], keys[order]
    starts = run_starts(shard)
    for s, e in zip(starts, np.append(starts[1:], len(order))):
        held = arrays.mapped(model.folder, f"{level}-{shard[s]}")
        if not held:  # no n-gram of the corpus fell into this shard
            continue
        hit, here = _find(held, index, keys[s:e])
        here = here[hit]
        rows[s:e][hit] = held[values][here] if level == 1 else _counts(held, values, here)
    found[order] = rows
    return found


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct keys, in the order of the keys, and for each key the number of its distinct one."""
    order = np.argsort(keys)
    starts = run_starts(keys[order])
    number = np.zeros(len(order), np.int32)
    number[starts[1:]] = 1
    back = np.empty(len(order), np.int32)
    back[order] = np.cumsum(number, dtype=np.int32)
    return order[starts], back


def log_chances(model: Model, own: np.ndarray, flat: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 chance of each token after its context, and the token's count in training.

    ``own`` are the distinct words in order, ``flat`` the texts by places among them, ``place`` where the tokens are.
    """
    back = flat[place]
    seen = _look_up(model, 1, word_shard(own, model.word_shards), own, "keys", "counts", 2)
    d, n = model.discounts(1), model.count_of_counts.get(1, [0, 0, 0, 0])
    some = max(model.types, 1)
    if model.continuations:
        more = max(0, model.types - n[0] - n[1])
        rest = (d[1] * n[0] + d[2] * n[1] + d[3] * more) / model.continuations
        chance = np.maximum(seen[:, 1] - d[np.minimum(seen[:, 1], 3)], 0) / model.continuations + rest / (some + 1)
    else:
        chance = np.full(len(own), 1.0 / (some + 1))
    counts, words, last = seen[back, 0], own[back], flat[place - 1]
    common, spreads = marked(own, model.hot, model.spreads)
    context, spread = own[last], spreads[last]
    for level in range(2, model.order + 1):
        if level > 2:
            near = flat[place - (level - 1)]
            context, spread = mix(context, own[near]), np.minimum(spread, spreads[near])
        keys = mix(context, words)
        first, to = _unique(keys)
        ctx, dealt, hot = context[first], spread[first], common[last[first]]
        base, shard = shard_of(own[last[first]], ctx, words[first], hot, dealt, model.shards)
        c = _look_up(model, level, shard, keys[first], "keys", "counts", 1)[:, 0]
        one, up = _unique(ctx)
        total, after = np.zeros((len(one), 4), np.int64), model.shards * hot[one]
        dealt, base, ctx, at = dealt[one], base[one], ctx[one], np.arange(len(one))
        for salt in range(int(dealt.max(initial=0))):  # the sums of a hot context lie in as many shards, from salt 0 on
            at = at[dealt[at] > salt]
            shard = (base[at] + salt) % model.shards + after[at]
            total[at] += _look_up(model, level, shard, ctx[at], "contexts", "totals", 4)
        d = model.discounts(level)
        seen_at_all = total[:, 0] > 0  # else the shorter context says all
        known = np.maximum(total[:, 0], 1)
        rest = np.where(seen_at_all, (total[:, 1:] @ d[1:]) / known, 1.0)
        direct = np.maximum(c - d[np.minimum(c, 3)], 0) / known[up]
        # equal n-grams have equal shorter ones, so each is reckoned once
        chance, back = direct + rest[up] * chance[back[first]], to
    return np.log10(chance)[back], counts


_SCORES = columns("n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, the ``keep`` columns, n_tokens, n_known, train_tokens, base_score, score and perplexity of each text.

    ``score`` is the model's log10 probability of the whole text with its end token, ``base_score`` that of single
    token frequencies with half a count added. Null and empty texts are one end token. Rows are scored by
    themselves, so repeated rows and ids come out as they are; other columns, of any name, are passed over; an empty table gives an
    empty result.
    """
    keep = keep or []
    source = df.select(
        F.col(id_col).cast("long").alias("doc_id"), *[F.col(c) for c in keep], F.col(text_col).cast("binary").alias("__text")
    )
    out = T.StructType([*source.schema.fields[:-1], *_SCORES.fields])

    def judged(texts: list[bytes | None]) -> list[np.ndarray]:
        own, flat, place, number = numbered(texts, model.order)
        chance, counts = log_chances(model, own, flat, place)
        base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
        per = [np.bincount(number, weights=w, minlength=len(texts)) for w in (np.ones(len(number)), counts > 0, base, chance)]
        return [per[0].astype(np.int64), per[1].astype(np.int64), np.full(len(texts), model.tokens), per[2], per[3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow(out)
        for batch in batches:
            start, held, size = 0, [], 0
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                held.append(text.as_py())
                size += len(held[-1] or b"") // 6
                if size >= RUN // 2 or i == batch.num_rows - 1:
                    columns = [batch.column(j).slice(start, len(held)).cast(schema.field(j).type) for j in range(batch.num_columns - 1)]
                    found = [pa.array(c) for c in judged(held)]
                    yield pa.RecordBatch.from_arrays(columns + found, schema=schema)
                    start, held, size = i + 1, [], 0

    scored = source.mapInArrow(run, out)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
