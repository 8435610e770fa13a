"""Exact top-k by integer inner product, with Fagin's threshold algorithm over blocks of sorted lists.

Candidates are ordered by their largest components, cut into blocks and written to the shared folder. A block has one list
per dimension, sorted by that component, and its lists' heads lie apart. A task holds a pack of queries and their k
best; it walks the blocks, the most promising first, and carries the k best from block to block. The bound of a query
is what the components at which its lists stand would score. A query leaves a block, or never opens it, when that
cannot beat its k-th best score. Only the k best of each query leave a task, whatever the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcycle.llm import arrays
from loadcycle.llm.common import columns, cut, scratch_path, small_batches, to_arrow

#: Candidates in a block and queries in a pack at the most; blocks that one task writes on average; largest components by which
#: vectors are ordered.
BLOCK, PACK, PART, LEADS = 8192, 512, 64, 3

#: Below every score: the place of a query's result that is not found yet.
_NONE = -(1 << 62)


def scaled(vector: str, scale: int = 64) -> Column:
    """floor(scale * x) of each component, as whole numbers; null if the vector cannot take part."""
    own = F.col(vector)
    bad = F.exists(own, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(own, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(own.isNotNull() & ~bad, whole)


def _alike(rows: DataFrame, parts: int) -> DataFrame:
    """Rows in order of their largest components, so that like vectors come together. Equal rows are dealt by their place."""
    sized = F.transform("v", lambda x, i: F.struct(F.abs(x).alias("size"), (i * 2 + (x > 0).cast("int")).alias("lead")))
    largest = F.slice(F.sort_array(sized, asc=False), 1, LEADS)
    order = ["dims", "leads", "vec_id", "v", "deal"]
    marked = rows.select(
        "vec_id", "v", F.size("v").alias("dims"), F.transform(largest, lambda x: x["lead"]).alias("leads"),
        F.monotonically_increasing_id().alias("deal"),
    )
    return marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("vec_id", "dims", "v")


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimensions, ids and matrix of up to ``size`` rows of as many dimensions."""
    held, count, at = [], 0, -1
    for batch in batches:
        ids, dims, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        start = 0
        while start < len(ids):
            if dims[start] != at or count == size:
                if count:
                    yield at, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held, count, at = [], 0, int(dims[start])
            end = start + min(size - count, int(np.argmin(np.append(dims[start:] == at, False))))
            values = vectors.slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
            held.append((ids[start:end], values.astype(np.int64).reshape(end - start, at)))
            count, start = count + end - start, end
    if count:
        yield at, np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(np.abs(values).max(initial=0))
    return values.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if most <= np.iinfo(t).max))


def bound(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The score that no vector between ``low`` and ``high`` can beat, for each query."""
    return np.maximum(queries, 0) @ high.astype(np.int64) + np.minimum(queries, 0) @ low.astype(np.int64)


class Best:
    """The k best of each query of a pack so far: higher scores first, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.ids, self.scores = np.zeros((queries, k), np.int64), np.full((queries, k), _NONE)

    @property
    def last(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Takes in scores of the queries at these places; a query may come many times."""
        k, changed = self.ids.shape[1], np.unique(query)
        query = np.concatenate((np.repeat(changed, k), query))
        ids = np.concatenate((self.ids[changed].ravel(), ids))
        scores = np.concatenate((self.scores[changed].ravel(), scores))
        order = np.lexsort((ids, -scores, query))
        first = np.searchsorted(query[order], changed)[:, None] + np.arange(k)  # each has k places at least
        self.ids[changed], self.scores[changed] = ids[order][first], scores[order][first]


class SortedLists:
    """One block: its ids and vectors and, for each dimension, the positions in the order of that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable") if order is None else order
        self._each = np.arange(vectors.shape[1])

    def between(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Highest and lowest component in each dimension of what lies deeper than ``depth`` from both ends of its list."""
        return self.vectors[self.order[-1 - depth], self._each], self.vectors[self.order[depth], self._each]

    def search(self, own: np.ndarray, queries: np.ndarray, best: Best, live: np.ndarray) -> int:
        """Walks all lists from both ends for the queries at the places ``live``; gives the number of rows scored.

        Each step scores what the lists have met for all queries still live. Candidates with a query's ``own`` id take
        no part for it. At a tie with the bound a smaller id may still be unseen, so only a higher k-th score ends a walk.
        """
        count, k = len(self.ids), best.ids.shape[1]
        seen = np.zeros(count, bool)
        most = int(np.abs(self.vectors.astype(np.int64)).max(initial=0)) * int(np.abs(queries).max(initial=0)) * queries.shape[1]
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64  # in which all sums are exact
        depth, step = 0, max(8, k)
        while depth < count and not seen.all():
            live = live[best.last[live] <= bound(queries[live], *self.between(depth))]
            if not len(live):
                break
            end = min(count, depth + step)
            met = np.full(count, end == count)
            met[self.order[depth:end]] = True
            met[self.order[count - end : count - depth]] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            self._score(fresh, own, queries, best, live, kind)
            depth, step = end, step * 2
        return int(seen.sum())

    def _score(self, rows, own, queries, best, live, kind) -> None:
        k, ids = best.ids.shape[1], self.ids[rows]
        found = queries[live].astype(kind) @ self.vectors[rows].astype(kind).T
        same = np.flatnonzero(np.isin(ids, own[live]))
        if len(same):
            found[:, same] = np.where(ids[same] == own[live][:, None], kind(_NONE), found[:, same])
        least = np.maximum(best.last[live], _NONE + 1).astype(kind)
        new = np.flatnonzero(best.last[live] == _NONE)
        if len(new) and len(rows) > k:  # the k-th best of these rows is a first limit
            least[new] = np.maximum(least[new], np.partition(found[new], len(rows) - k, axis=1)[:, len(rows) - k])
        query, row = np.nonzero((found >= least[:, None]) & (found != kind(_NONE)))
        if len(query):
            best.add(live[query], ids[row], found[query, row].astype(np.int64))


_WRITTEN = columns("part int, blocks long")
_FOUND = columns("query_id long, vec_id long, score long, blocks long, searched long, scored long")


def _write(rows: DataFrame, folder: str, block: int) -> None:
    """Blocks as files, and the heads of the lists of each task's blocks in one file for each number of dimensions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, heads, number = TaskContext.get().partitionId(), {}, 0
        for dims, ids, vectors in _groups(batches, block):
            lists = SortedLists(ids, vectors)
            arrays.save(folder, f"block-{part}-{number}", {
                "ids": ids, "vectors": _narrow(vectors), "order": lists.order.astype("<u2" if len(ids) <= 1 << 16 else "<u4"),
            })
            heads.setdefault(dims, []).append((number, *lists.between(0)))
            number += 1
        for dims, held in heads.items():
            numbers, high, low = zip(*held)
            arrays.save(folder, f"heads-{dims}-{part}", {
                "number": np.array(numbers), "high": _narrow(np.array(high)), "low": _narrow(np.array(low)),
            })
        yield pa.RecordBatch.from_pylist([{"part": part, "blocks": number}], schema=to_arrow(_WRITTEN))

    rows.mapInArrow(run, _WRITTEN).agg(F.sum("blocks")).collect()  # one number


def _in_turn(folder: str, dims: int, parts: int, queries: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Block names with their lists' heads, those first that promise the pack most on average."""
    names, high, low, promise = [], [], [], []
    up, down = np.maximum(queries, 0).mean(axis=0), np.minimum(queries, 0).mean(axis=0)
    for part in range(parts):
        held = arrays.mapped(folder, f"heads-{dims}-{part}")
        if held:
            names += [f"block-{part}-{n}" for n in held["number"].tolist()]
            high.append(np.array(held["high"]))
            low.append(np.array(held["low"]))
            promise.append(high[-1] @ up + low[-1] @ down)
    if names:
        high, low = np.concatenate(high), np.concatenate(low)
        for at in np.argsort(-np.concatenate(promise), kind="stable"):
            yield names[at], high[at], low[at]


def walks(
    df: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 64, block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """The k best of each query row (query_id, vec_id, score), with the number of blocks, of blocks that its pack opened for
    it, and of rows scored in them. See ``top_k``, which ranks them."""
    spark = df.sparkSession
    small_batches(spark)

    def rows(source: DataFrame) -> DataFrame:
        return source.select(F.col(id_col).cast("long").alias("vec_id"), scaled(vector_col, scale).alias("v")).filter(
            "vec_id is not null and v is not null"
        )

    every, asked = cut(rows(df), "vectors"), cut(rows(queries), "queries")
    cores = spark.sparkContext.defaultParallelism
    blocks, packs = -(-every.count() // block), -(-asked.count() // pack)
    parts = max(1, min(blocks, max(cores, -(-blocks // PART))))
    folder = scratch_path(spark, "blocks")
    _write(_alike(every, parts), folder, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, own, vectors in _groups(batches, pack):
            best = Best(len(own), k)
            count, opened, scored = 0, np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            for name, high, low in _in_turn(folder, dims, parts, vectors):
                count += 1
                live = np.flatnonzero(best.last <= bound(vectors, high, low))
                if len(live):
                    held = arrays.mapped(folder, name)
                    opened[live] += 1
                    scored[live] += SortedLists(held["ids"], held["vectors"], held["order"]).search(own, vectors, best, live)
            query, place = np.nonzero(best.scores != _NONE)
            found = [own[query], best.ids[query, place], best.scores[query, place], np.full(len(query), count), opened[query], scored[query]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=to_arrow(_FOUND))

    return _alike(asked, max(1, packs, cores)).mapInArrow(run, _FOUND)


def top_k(
    df: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 64, block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query, ties to the smaller id.

    ``queries`` are rows of the same kind. A row is known by its id: rows with the query's id are the query itself, and
    queries that share an id share k places. Vectors that are null or hold null or non-finite components and rows without an id take no
    part; vectors are compared with those of as many dimensions. Fewer than k candidates give all of them; an empty table none.
    Other columns, of any name, are passed over.

    Each pack of queries reads the blocks that its bounds do not rule out, so ``pack`` sets how often the candidates are read.
    A worker holds the heads of all blocks, two rows of each ``block`` candidates.
    """
    found = walks(df, queries, k, id_col=id_col, vector_col=vector_col, scale=scale, block=block, pack=pack)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
