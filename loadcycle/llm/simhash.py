"""SimHash near-duplicates: fingerprints, bit-sliced comparison in blocks, components.

Fingerprints within ``radius`` bits of each other agree on at least one of ``radius + 1`` bands of bits, so they meet
under that band's value. A meeting place that holds too many is dealt again by bands of the bits that are left; each
such step fixes more bits, and as fingerprints are distinct, a place with few free bits can only hold few. No
place is capped and no pair within the radius is missed.

In a place, fingerprints are stored as bit planes: one machine word holds one bit of 64 fingerprints. A query adds the
planes it differs in to carry-save counters, so 64 distances grow at once, and a block is left as soon as all of its
counters exceed the radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.llm.common import ROW_HASH, columns, cut, join_hot, keep_rows, per_text, row_hash, to_arrow
from loadcycle.llm.components import components

BITS = 64
#: Fingerprints that one meeting place may hold before it is dealt again.
PLACE = 2048
#: A fingerprint of more than one in so many rows is joined without a shuffle; there are fewer than that.
HOT_SHARE = 1024
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: bytes, width: int, seed: int) -> np.ndarray:
    """XXH64 of each run of ``width`` lower-cased words, repeats included; of all words if there are fewer."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    return np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :])), np.uint64, len(words) - width + 1
    )


def simhash(text: bytes, width: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, width, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(
    df: DataFrame, *, width: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, __row_hash and fp (the 64 bits as a signed long) of each row; null and wordless texts have 0."""

    def make():
        def one(text: bytes | None) -> tuple:
            bits = simhash(text or b"", width, seed)
            return (bits - (1 << 64) if bits >> 63 else bits,)

        return one

    rows = df.select(F.col(id_col).alias("doc_id"), row_hash(text_col).alias(ROW_HASH), F.col(text_col).alias("text"))
    return per_text(rows, make, "fp long", id_col="doc_id", text_col="text", keep=[ROW_HASH])


def planes(block: np.ndarray) -> np.ndarray:
    """Bit planes of a block: row b holds bit b of each fingerprint, 64 fingerprints to a word."""
    rows = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    words = -(-len(block) // 64)
    padded = np.zeros((BITS, words * 64), np.uint8)
    padded[:, : len(block)] = rows
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within(block_planes: np.ndarray, size: int, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, member) of all pairs within the radius.

    All queries go through the planes together: counter planes hold each distance in binary up to a saturating
    ``over`` plane, and queries whose whole block is over leave early.
    """
    levels = max(1, radius.bit_length())
    words = block_planes.shape[1]
    active = np.arange(len(queries))
    counters = np.zeros((levels, len(queries), words), np.uint64)
    over = np.zeros((len(queries), words), np.uint64)
    tail = np.full(words, ~np.uint64(0))
    if size % 64:
        tail[-1] = np.uint64((1 << (size % 64)) - 1)
    over[:, :] = ~tail
    bits = queries.astype(np.uint64)
    for b in range(BITS):
        flip = -((bits[active] >> np.uint64(b)) & np.uint64(1)).astype(np.int64)
        carry = block_planes[b][None, :] ^ flip.astype(np.uint64)[:, None]
        for level in range(levels):  # add one where the bits differ
            held = counters[level, active]
            counters[level, active] = held ^ carry
            carry = carry & held
        over[active] |= carry
        if b % 8 == 7 and b < BITS - 1:
            some = _not_over(counters[:, active], over[active], radius).any(axis=1)
            active = active[some]
            if not len(active):
                break
    good = _not_over(counters[:, active], over[active], radius)
    who, word = np.nonzero(good)
    lanes = np.unpackbits(good[who, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pair, lane = np.nonzero(lanes)
    return active[who[pair]], word[pair] * 64 + lane


def _not_over(counters: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count is at most the radius: binary comparison of the counter planes with a constant."""
    less, equal = np.zeros_like(over), ~over
    for level in range(len(counters) - 1, -1, -1):
        if radius >> level & 1:
            less |= equal & ~counters[level]
            equal = equal & counters[level]
        else:
            equal = equal & ~counters[level]
    return less | equal


def _forest(block: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is within the radius in one place, at most one fewer than there are members."""
    size = len(block)
    if size == 2:
        return [(0, 1)] if bin(int(block[0]) ^ int(block[1])).count("1") <= radius else []
    root = list(range(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sliced, links = planes(block), []
    for start in range(0, size, 256):
        for q, m in zip(*within(sliced, size, block[start : start + 256], radius)):
            a, b = find(start + int(q)), find(int(m))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((start + int(q), int(m)))
    return links


def _bands(free: list[int], count: int) -> list[list[int]]:
    step, extra = divmod(len(free), count)
    out, at = [], 0
    for i in range(count):
        width = step + (i < extra)
        out.append(free[at : at + width])
        at += width
    return out


def _paths(radius: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(choice of band at each step, mask of all bits fixed) for every meeting place of that depth."""
    found = [((), 0, list(range(BITS)))]
    for _ in range(depth):
        found = [
            ((*path, i), mask | sum(1 << b for b in band), [b for b in free if b not in band])
            for path, mask, free in found
            for i, band in enumerate(_bands(free, radius + 1))
        ]
    return [(path, mask) for path, mask, _ in found]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _places(fps: DataFrame, radius: int, depth: int) -> DataFrame:
    """fp, path number, the value of the bits that the place fixes, and the path one step up."""
    paths = _paths(radius, depth)
    below = {p: i for i, (p, _) in enumerate(_paths(radius, depth - 1))} if depth > 1 else {(): 0}
    choices = F.array(*[
        F.struct(
            F.lit(i).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value"),
            F.lit(below[path[:-1]]).alias("up"),
        )
        for i, (path, mask) in enumerate(paths)
    ])
    return fps.select("fp", F.explode(choices).alias("p")).select("fp", "p.path", "p.value", "p.up")


_LINKS = columns("a long, b long")


def _compare(dealt: DataFrame, radius: int) -> DataFrame:
    """Links of the places, whose rows lie together in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow(_LINKS)
        held_path, held_value, held_fp = (np.empty(0, np.int64) for _ in range(3))

        def links(path, value, fp, finish: bool):
            """Links of all places but the last, which the next batch may go on with."""
            change = np.flatnonzero((path[1:] != path[:-1]) | (value[1:] != value[:-1])) + 1
            starts = np.concatenate(([0], change)) if len(path) else np.empty(0, np.int64)
            ends = np.concatenate((change, [len(path)])) if len(path) else np.empty(0, np.int64)
            if not finish and len(starts):
                rest, starts, ends = starts[-1], starts[:-1], ends[:-1]
            else:
                rest = len(path)
            a, b = [], []
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s > 1:
                    block = fp[s:e]
                    for i, j in _forest(block.view(np.uint64), radius):
                        a.append(int(block[i]))
                        b.append(int(block[j]))
            return rest, pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

        for batch in batches:
            path = np.concatenate((held_path, batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            value = np.concatenate((held_value, batch.column(1).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((held_fp, batch.column(2).to_numpy(zero_copy_only=False)))
            rest, out = links(path, value, fp, False)
            held_path, held_value, held_fp = path[rest:], value[rest:], fp[rest:]
            yield out
        yield links(held_path, held_value, held_fp, True)[1]

    return dealt.select("path", "value", "fp").mapInArrow(run, _LINKS)


def near_links(fps: DataFrame, radius: int = 2, place: int = PLACE) -> DataFrame:
    """Links a, b between distinct fingerprints that connect all that are within the radius of each other.

    ``fps`` has one distinct non-null long column fp. Each place gives at most as many links as it has members.
    """
    links, now, depth = None, fps.select("fp"), 1
    waiting = None  # the places, by path and value, that were too full one step up
    while True:
        free = BITS - min(bin(mask).count("1") for _, mask in _paths(radius, depth))
        spread = _places(now, radius, depth)
        if waiting is not None:
            masks = _paths(radius, depth - 1)
            up = F.element_at(F.array(*[F.lit(_signed(m)) for _, m in masks]), F.col("up") + 1)
            spread = spread.withColumn("up_value", F.col("fp").bitwiseAND(up)).join(
                waiting.select(F.col("path").alias("up"), F.col("value").alias("up_value")), ["up", "up_value"], "left_semi"
            )
        counts = spread.groupBy("path", "value").count().filter("count > 1")
        counts = cut(counts, "places")
        last = 2**free <= place or free <= 12
        light = counts if last else counts.filter(F.col("count") <= place)
        shared = spread.select("path", "value", "fp").join(light.select("path", "value"), ["path", "value"])
        tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, so that small rows do not bring it to one
        dealt = shared.repartition(tasks, "path", "value").sortWithinPartitions("path", "value", "fp")
        found = _compare(dealt, radius)
        links = found if links is None else links.unionByName(found)
        if last:
            return links
        waiting = counts.filter(F.col("count") > place).select("path", "value")
        if waiting.isEmpty():
            return links
        masks = _paths(radius, depth)
        own = F.explode(F.array(*[
            F.struct(F.lit(i).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
            for i, (_, m) in enumerate(masks)
        ])).alias("p")
        now = cut(
            now.select("fp", own).select("fp", "p.path", "p.value").join(waiting, ["path", "value"], "left_semi")
            .select("fp").distinct(), "crowded",
        )
        depth += 1


def near_duplicates(
    df: DataFrame, *, width: int = 3, seed: int = 42, radius: int = 2, place: int = PLACE, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, __row_hash, fp and component_id, the smallest doc_id reachable over links.

    Rows with one fingerprint are linked, wordless and null texts (fingerprint 0) too. Null ids are passed over in the
    choice of the smallest; a component without any id has a null component_id. Equal fingerprints are one
    node of the link table, so a group of copies of any size adds no links. A very long text is one fingerprint, made by one
    task. Other columns, of any name, are passed over. An empty table gives no rows.
    """
    docs = cut(
        fingerprints(df, width=width, seed=seed, id_col=id_col, text_col=text_col), "fingerprints"
    )
    nodes = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "nodes")
    hot = nodes.filter(F.col("rows") > docs.count() / HOT_SHARE + 1)
    roots = components(near_links(nodes.select("fp"), radius, place))
    rooted = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(rooted.join(names, "root").select("fp", "root", "component_id"), "named")
    return join_hot(docs, named, "fp", hot).select("doc_id", ROW_HASH, "fp", "root", "component_id")


def one_of_each(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The row with the smallest id of each component, with its own columns; ties by text hash, null ids last."""
    marked = near_duplicates(df, id_col=id_col, text_col=text_col, **how)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW_HASH)
    kept = marked.groupBy("root").agg(F.min(order).alias("k")).select("k.doc_id", f"k.{ROW_HASH}")
    return keep_rows(df, kept, id_col, text_col)
