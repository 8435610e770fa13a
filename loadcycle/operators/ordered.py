"""Ordered work without one task per group.

A window over a whole group (or over the whole table) runs in one task. Here the order is cut into
slices at quantiles of the data, so every slice holds about the same number of rows whatever the
distribution. A small frame holds one summary per group and slice, a running pass over that frame
says what every slice inherits from the ones before it, and that inheritance enters the slice as an
opening row. The large window then runs per group and slice: a group that holds a third of all rows
spreads over a third of the slices.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from loadcycle.functions import times

_SLICE = "__slice"
_ROW = "__row"  # 0 for the opening row of a slice, 1 for data
_EXACT = float(1 << 53)  # whole numbers below this are exact as doubles


@dataclass(frozen=True)
class Bounds:
    """Where an order is cut. They decide how work is spread, never what comes out.

    Positions are doubles counted from ``base``; a larger value never has a smaller position, so the slices
    follow the order even where positions are rounded. ``heavy`` are positions that more than one slice of rows
    share and that stand for one value exactly; those rows are cut again by the second column of the order,
    at ``tie_cuts``. ``spread`` is how many slices the heaviest fills.
    """

    cuts: tuple[float, ...] = ()
    heavy: tuple[float, ...] = ()
    tie_cuts: tuple[float, ...] = ()
    spread: int = 1
    base: int = 0

    def merged(self, other: Bounds) -> Bounds:
        """Cuts of both, for rows that come from two sources."""
        if self.base != other.base:
            return Bounds(self.cuts, base=self.base)
        return Bounds(tuple(sorted({*self.cuts, *other.cuts})), base=self.base)


def _position(df: DataFrame, column: str, base: int = 0) -> Column:
    return _place(df.schema[column].dataType, F.col(column), base)


def _place(kind: T.DataType, value: Column, base: int = 0) -> Column:
    """Place in the order as a number; times in microseconds, whole numbers from ``base`` on."""
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        value = times.micros(value.cast("timestamp_ntz"))
    elif not isinstance(kind, T.IntegralType):
        return value.cast("double")
    if not base:
        return value.cast("double")
    beyond = F.lit(-math.inf if base > 0 else math.inf)  # too far away to subtract
    moved = F.try_subtract(value.cast("long"), F.lit(base)).cast("double")
    return F.when(value.isNotNull(), F.coalesce(moved, beyond))


#: Accuracy of the sketches: ranks are right to about a thousandth, a sketch takes some 100 kB.
SKETCH = 4096


def sketch(column: T.StructField) -> Column:
    """Aggregate: a mergeable quantile sketch of a column's positions in its order."""
    return F.kll_sketch_agg_double(_place(column.dataType, F.col(f"`{column.name}`")), SKETCH)


def merged_sketch(spark: SparkSession, a: str, b: str) -> str:
    """Two sketches (base64) as one. A row of values that Spark evaluates without a job."""
    both = spark.sql(f"SELECT base64(kll_sketch_merge_double(unbase64(a), unbase64(b))) FROM VALUES ('{a}', '{b}') AS t(a, b)")
    return "".join(both.first()[0].split())


def _ranks(wanted: int) -> Column:
    return F.array(*[F.lit(i / wanted) for i in range(1, wanted)])


def _quantiles(df: DataFrame, order: Sequence[str], wanted: int, base: int = 0) -> list[list[float]]:
    """Quantiles of the columns by a sketch each, which the tasks make and merge: one row comes back."""
    columns = [f"__p{i}" for i, _ in enumerate(order)]
    positions = df.select(*[_position(df, c, 0 if i else base).alias(p) for i, (c, p) in enumerate(zip(order, columns))])
    sketches = positions.agg(*[F.kll_sketch_agg_double(p, SKETCH).alias(p) for p in columns])
    row = sketches.select(*[_cuts_of(F.col(p), wanted).alias(p) for p in columns]).first()
    return [list(row[p] or []) for p in columns]


def _cuts_of(found: Column, wanted: int) -> Column:
    return F.when(F.kll_sketch_get_n_double(found) > 0, F.kll_sketch_get_quantile_double(found, _ranks(wanted)))


def _wanted(spark: SparkSession, slices: int | None) -> int:
    return slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def sketched_bounds(spark: SparkSession, kind: T.DataType, found: str | None, slices: int | None = None) -> Bounds | None:
    """Bounds of an order by one column from its sketch (base64) over all rows, without a job.

    None where there is no sketch, or where its positions are too large to be exact.
    """
    wanted = _wanted(spark, slices)
    if found is None or wanted < 2:
        return None if found is None else Bounds()
    row = spark.sql(f"SELECT unbase64('{found}') AS s FROM VALUES (1) AS t(one)").select(_cuts_of(F.col("s"), wanted)).first()
    first = list(row[0] or [])
    if _is_whole(kind) and first and max(map(abs, first)) >= _EXACT:
        return None
    return _bounds(first, [], _is_whole(kind), 0)


def _is_whole(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.TimestampType, T.TimestampNTZType))


def _bounds(first: list[float], rest: list[list[float]], whole: bool, base: int) -> Bounds:
    seen = Counter(first)
    heavy = sorted(v for v, often in seen.items() if often > 1 and not (whole and abs(v) >= _EXACT))
    cuts = sorted({*first, *(math.nextafter(v, math.inf) for v in heavy)} - {-math.inf, math.inf})
    tie_cuts = sorted(set(rest[0])) if rest and heavy else ()
    spread = max((seen[v] for v in heavy), default=0) + 1
    return Bounds(tuple(cuts), tuple(heavy), tuple(tie_cuts), spread, base)


def slice_bounds(df: DataFrame, order: Sequence[str], slices: int | None = None) -> Bounds:
    """Quantiles of the order of these very rows, from a pass that reads its first two columns only.

    By default there are four slices per shuffle partition, so the spread follows the cluster. Whole numbers
    too large for a double are counted from the first quantile, in a second pass.
    """
    wanted = _wanted(df.sparkSession, slices)
    if wanted < 2:
        return Bounds()
    order, base = order[:2], 0
    first, *rest = _quantiles(df, order, wanted)
    whole = _is_whole(df.schema[order[0]].dataType)
    if whole and first and max(map(abs, first)) >= _EXACT:
        base = max(-(1 << 63), min((1 << 63) - 1, int(first[0])))
        first, *rest = _quantiles(df, order, wanted, base)
    return _bounds(first, rest, whole, base)


def _bucket(df: DataFrame, column: str, cuts: Sequence[float], name: str) -> DataFrame:
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)


def _sliced(df: DataFrame, order: Sequence[str], bounds: Bounds) -> DataFrame:
    """Number the slices; they follow each other in ``order``, rows without a position come last."""
    at = _position(df, order[0], bounds.base)
    out = _bucket(df.withColumn("__at", at), "__at", bounds.cuts, "__bucket")
    number = F.col("__bucket")
    if bounds.tie_cuts:
        out = _bucket(out.withColumn("__tie", _position(df, order[1])), "__tie", bounds.tie_cuts, "__sub")
        sub = F.when(F.col("__at").isin(list(bounds.heavy)), F.col("__sub")).otherwise(F.lit(0.0))
        number = number * F.lit(float(len(bounds.tie_cuts) + 2)) + sub
    return out.withColumn(_SLICE, number.cast("long")).drop("__at", "__bucket", "__tie", "__sub")


def _before(keys: Sequence[str]):
    """All earlier slices of the group."""
    return W.partitionBy(*keys).orderBy(F.col(_SLICE).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _rank_struct(order: Sequence[str]) -> Column:
    """Comparable value in which null sorts last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])


def previous_in_group(
    df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], name: str, bounds: Bounds | None = None
) -> DataFrame:
    """``lag(value)`` per group. ``order`` is total: a time or number first, then a unique number."""
    data = _sliced(df, order, bounds or slice_bounds(df, order))
    tails = data.groupBy(*keys, _SLICE).agg(F.max_by(F.struct(F.col(value)), _rank_struct(order)).alias("__tail"))
    inherited = W.partitionBy(*keys).orderBy(F.col(_SLICE).asc_nulls_last())
    opening = tails.withColumn("__open", F.lag("__tail").over(inherited)).where(F.col("__open").isNotNull())
    opening = opening.select(*keys, _SLICE, F.lit(0).alias(_ROW), F.col(f"__open.`{value}`").alias("__value"))
    rows = data.withColumn(_ROW, F.lit(1)).withColumn("__value", F.col(value))
    window = W.partitionBy(*keys, _SLICE).orderBy(F.col(_ROW), *_nulls_last(order))
    united = rows.unionByName(opening, allowMissingColumns=True)
    return united.withColumn(name, F.lag("__value").over(window)).where(F.col(_ROW) == 1).drop(_SLICE, _ROW, "__value")


def running_sums(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str], bounds: Bounds | None = None
) -> DataFrame:
    """Every column replaced by its running total per group, the current row included."""
    data = _sliced(df, order, bounds or slice_bounds(df, order))
    totals = data.groupBy(*keys, _SLICE).agg(*[F.sum(c).alias(c) for c in columns])
    opening = totals.select(
        *keys, _SLICE, F.lit(0).alias(_ROW), *[F.sum(c).over(_before(keys)).alias(c) for c in columns]
    )
    united = data.withColumn(_ROW, F.lit(1)).unionByName(opening, allowMissingColumns=True)
    window = W.partitionBy(*keys, _SLICE).orderBy(F.col(_ROW), *_nulls_last(order))
    window = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = united.withColumns({f"__sum_{c}": F.sum(c).over(window) for c in columns}).where(F.col(_ROW) == 1)
    return summed.withColumns({c: F.col(f"__sum_{c}") for c in columns}).select(*df.columns)


def known_values(df: DataFrame, columns: Sequence[str], key: str, bounds: Bounds) -> DataFrame:
    """For every key with a gap, as ``__key``: the last value at or before it, as ``__known_i``.

    Works on one narrow row per key, so repeated keys collapse before the shuffle.
    """
    gap = F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()
    per_key = df.where(F.col(key).isNotNull()).groupBy(key)
    data = per_key.agg(F.bool_or(gap).alias("__gap"), *[F.max(c).alias(f"__known_{i}") for i, c in enumerate(columns)])
    known = [f"__known_{i}" for i, _ in enumerate(columns)]
    data = _sliced(data, [key], bounds)
    tails = data.groupBy(_SLICE).agg(
        F.bool_or("__gap").alias("__gap"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(key))).alias(c) for c in known],
    )
    # one row per slice, a few per shuffle partition: the unpartitioned window sees this summary only
    opening = tails.select(
        _SLICE, "__gap", F.lit(0).alias(_ROW), *[F.last(c, ignorenulls=True).over(_before([])).alias(c) for c in known]
    ).where("__gap")
    united = data.withColumn(_ROW, F.lit(1)).unionByName(opening, allowMissingColumns=True)
    window = W.partitionBy(_SLICE).orderBy(F.col(_ROW), F.col(key)).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = [F.last(c, ignorenulls=True).over(window).alias(c) for c in known]
    return united.select(F.col(key).alias("__key"), _ROW, "__gap", *last).where((F.col(_ROW) == 1) & F.col("__gap")).drop(_ROW, "__gap")


def _join_spread(df: DataFrame, found: DataFrame, key: str, bounds: Bounds) -> DataFrame:
    """Left join on the key; rows of a heavy key go to many tasks and meet a copy of its one row there."""
    if not bounds.heavy:
        return df.join(found, F.col(key) == F.col("__key"), "left")
    salts = bounds.spread

    def hot(frame: DataFrame, column: str) -> Column:
        return _position(frame, column, bounds.base).isin(list(bounds.heavy))

    # any spread will do: the result does not depend on the salt
    salt = F.when(hot(df, key), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0))
    every = F.when(hot(found, "__key"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = df.withColumn("__salt", salt.cast("int"))
    right = found.withColumn("__copy", F.explode(every))
    return left.join(right, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__copy")), "left")


def fill_forward(
    df: DataFrame, columns: Sequence[str], key: str, offset_ms: int = 0, bounds: Bounds | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Null becomes the last value before it in ``key`` order, ``offset_ms`` later.

    The offset does not add up over a run of nulls, and nulls before the first value stay. Rows
    that share a key share its highest value. Wide rows with a gap move once, for the join on the key; the others stay where
    they are. ``known`` may hold the ``known_values`` of these columns.
    """
    if not columns:
        return df
    bounds = bounds or slice_bounds(df, [key])
    found = known_values(df, columns, key, bounds) if known is None else known
    gap = reduce(or_, [F.col(c).isNull() for c in columns]) & F.col(key).isNotNull()
    joined = _join_spread(df.where(gap), found, key, bounds)
    filled = {c: F.coalesce(F.col(c), times.shift(F.col(f"__known_{i}"), offset_ms)) for i, c in enumerate(columns)}
    return df.where(~gap).unionByName(joined.withColumns(filled).select(*[F.col(f"`{c}`") for c in df.columns]))
