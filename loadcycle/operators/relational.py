"""Filters, projections, joins and one-row-per-key.

No join here carries a broadcast hint, but that of a bitmap of bounded size: Catalyst broadcasts a side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold``, shuffles both otherwise, and adaptive execution splits a
hot key's partition of the left side. Right sides are cut to one row per key first, so no join
multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


# Filters ------------------------------------------------------------------------------------

def alive(df: DataFrame, deleted_at: str = "tiem_elimin") -> DataFrame:
    """Rows without a deletion time."""
    return df.where(F.col(deleted_at).isNull())


def strictly_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both bounds excluded."""
    return df.where((F.col(column) > F.lit(low)) & (F.col(column) < F.lit(high)))


def after(df: DataFrame, column: str, moment) -> DataFrame:
    return df.where(F.col(column) > F.lit(moment))


def period_of_fleets(df: DataFrame, time: str, low, high, fleet: str, fleets: Sequence) -> DataFrame:
    return strictly_between(df, time, low, high).where(F.col(fleet).isin(*fleets))


# Projections --------------------------------------------------------------------------------

def select_as(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``{output name: source column}``; a source may be qualified by a DataFrame alias."""
    return df.select(*[F.col(source).alias(name) for name, source in mapping.items()])


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns by exact name; names with ``/`` or dots are safe."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Spaces and the characters that table formats refuse become underscores."""
    refused = " ,;{}()\n\t="
    return df.toDF(*["".join("_" if ch in refused else ch for ch in c) for c in df.columns])


# One row per key ----------------------------------------------------------------------------

def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def total_order(df: DataFrame, first: Sequence[Column], named: Sequence[str]) -> list[Column]:
    """``first`` followed by every other orderable column, so that only identical rows tie."""
    rest = [F.col(f"`{f.name}`").asc_nulls_last() for f in df.schema if f.name not in named and _orderable(f.dataType)]
    return [*first, *rest]


def by_content(df: DataFrame) -> Column:
    """A sort key from the whole row: no preference, but the same choice on every run and retry."""
    kept = [F.col(f"`{f.name}`") for f in df.schema if _orderable(f.dataType)]
    return F.xxhash64(*kept)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key under ``order``.

    Filtering ``row_number`` to 1 lets Spark drop the losers in each task before the shuffle
    (WindowGroupLimit), so a hot key sends one row per task, not all of its rows.
    """
    rank = "__rank"
    window = W.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """A dimension without repeated keys; rows whose key is null can match nothing and go."""
    return keep_one(df.where(F.col(key).isNotNull()), [key], [by_content(df)])


def latest_per_key(df: DataFrame, key: str, by: str) -> DataFrame:
    """Newest version of every key."""
    return keep_one(df.where(F.col(key).isNotNull()), [key], [F.col(by).desc_nulls_last(), by_content(df)])


#: Bits of the hashed key set by which rows are left out of a shuffle; 2 MB, whatever the input.
KEY_BITS = 1 << 24


def with_keys_of(df: DataFrame, key: str, keys: DataFrame, other: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys``; all rows of a key stay or go together. Nothing of ``df`` is shuffled.

    A key that is among them always stays, one that is not may stay too, so an exact join must follow. The keys go to
    the tasks as bitmaps of their hashes, 512 of 4 kB at the most. Keys of different types, whole numbers aside, are not looked at.
    The key comes out as the first column, as from a semi-join by its name, so choices by a row's content stay what they are.
    """
    df = df.select(key, *[F.col(f"`{c}`") for c in df.columns if c != key])
    kinds = [df.schema[key].dataType, keys.schema[other].dataType]
    whole = all(isinstance(kind, T.IntegralType) for kind in kinds)
    if not whole and kinds[0] != kinds[1]:
        return df.where(F.col(key).isNotNull())

    def place(column: str) -> Column:
        return _place(F.col(column).cast("long") if whole else F.col(column))

    maps = _bitmaps(keys.where(F.col(other).isNotNull()).select(place(other).alias("__bit")))
    rows = df.where(F.col(key).isNotNull()).join(F.broadcast(maps), F.bitmap_bucket_number(place(key)) == F.col("__map"))
    return rows.where(_held(place(key))).drop("__map", "__bits")


def _place(*columns: Column) -> Column:
    """Place of a hash among the bits."""
    return F.pmod(F.xxhash64(*columns), F.lit(KEY_BITS))


def _bitmaps(places: DataFrame) -> DataFrame:
    """The places in column ``__bit`` as bitmaps of 4 kB, 512 at the most."""
    set_bits = F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__bits")
    return places.groupBy(F.bitmap_bucket_number("__bit").alias("__map")).agg(set_bits)


def _held(place: Column) -> Column:
    """Is the place's bit set in ``__bits``?"""
    at = F.bitmap_bit_position(place)
    held = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(held, (at % 8).cast("int")) == 1


def repeated_marks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What more than one row has in these columns, as bitmaps of hashes: 2 MB, whatever the input. Only hashes are shuffled."""
    hashes = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("__hash")).groupBy("__hash").agg(F.count(F.lit(1)).alias("__rows"))
    return _bitmaps(hashes.where(F.col("__rows") > 1).select(F.pmod("__hash", F.lit(KEY_BITS)).alias("__bit")))


def split_by_marks(df: DataFrame, columns: Sequence[str], marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that no other row equals in these columns, and rows that some other row may equal. Nothing of ``df`` is shuffled.

    Rows that are equal in these columns go to the same side.
    """
    place = _place(*[F.col(f"`{c}`") for c in columns])
    marked = df.join(F.broadcast(marks), F.bitmap_bucket_number(place) == F.col("__map"), "left")
    repeated = F.coalesce(_held(place), F.lit(False))
    return tuple(marked.where(x).select(*[F.col(f"`{c}`") for c in df.columns]) for x in (~repeated, repeated))


# Joins --------------------------------------------------------------------------------------

def left_lookup(df: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left equi-join on differently named keys; the right key is dropped."""
    joined = df.join(right, F.col(left_key) == right[right_key], "left")
    return joined.drop(right[right_key])


def left_join_spreading_nulls(df: DataFrame, right: DataFrame, left_key: str, right_key: str, row: str) -> DataFrame:
    """Left equi-join in which rows without a key are dealt over all tasks by ``row``; they match nothing.

    The key is the only column of the equation, so a right side that is already partitioned by it stays where it is.
    """
    left = df.withColumn("__none", F.col(left_key).isNull()).withColumn(
        "__at", F.coalesce(F.col(left_key), F.xxhash64(F.col(row)))
    )
    return left.join(right, (F.col("__at") == F.col(right_key)) & ~F.col("__none"), "left").drop("__none", "__at")


def with_role(df: DataFrame, key: str, role: str) -> DataFrame:
    """The same dimension in another role: every column gets the role as suffix, the key included."""
    return df.select(*[F.col(c).alias(f"{c}_{role}") for c in df.columns])


def three_level_tree(nodes: DataFrame, key: str, parent: str, name: str, is_group: str) -> DataFrame:
    """Leaves of a parent-pointer table with the names of both groups above them.

    Roots have parent 0. Every column of the leaf is kept.
    """
    roots = nodes.where(F.col(parent) == 0).select(F.col(key).alias("id_principal"), F.col(name).alias("principal"))
    groups = nodes.select(
        F.col(key).alias("id_secundario"), F.col(name).alias("secundario"), F.col(parent).alias("__root")
    )
    groups = groups.join(roots, F.col("__root") == F.col("id_principal")).drop("__root")
    leaves = nodes.where((F.col(parent) != 0) & ~F.col(is_group))
    return leaves.join(groups, F.col(parent) == F.col("id_secundario"))


def names_up_the_tree(
    df: DataFrame, nodes: DataFrame, key: str, parent: str, name: str, start: str, first: str, second: str
) -> DataFrame:
    """Name of the node that ``start`` points at, and of that node's parent."""
    unique = one_per_key(nodes.select(key, parent, name), key)
    near = unique.select(F.col(key).alias("__near"), F.col(name).alias(first), F.col(parent).alias("__up"))
    far = unique.select(F.col(key).alias("__far"), F.col(name).alias(second))
    found = df.join(near, F.col(start) == F.col("__near"), "left")
    found = found.join(far, F.col("__up") == F.col("__far"), "left")
    return found.drop("__near", "__up", "__far")


# Order, limits, unions ----------------------------------------------------------------------

def first_rows(df: DataFrame, by: str, count: int) -> DataFrame:
    """Smallest ``count`` rows, nulls last (a top-k in every task, then one merge)."""
    return df.orderBy(F.col(by).asc_nulls_last()).limit(count)


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def time_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))
