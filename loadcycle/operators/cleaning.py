"""Profiling, imputation, deduplication and type repair."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.functions import text, times
from loadcycle.operators.facts import ColumnFacts, Counter, column_facts
from loadcycle.operators.relational import keep_one, total_order


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def missing(field: T.StructField) -> Column:
    """Null, and not-a-number where the type has it."""
    column = _name(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


# Profile ------------------------------------------------------------------------------------

def null_profile(df: DataFrame) -> DataFrame:
    """Column, null count and null percentage, most nulls first. One pass, one row of counters."""
    counts = df.agg(*Counter(df.schema, find_dates=False).aggregates())
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("present")) for i, c in enumerate(df.columns)]
    )
    long = counts.select(F.col("rows").alias("__rows"), F.explode(pairs).alias("p")).select("p.column", "p.present", "__rows")
    long = long.select("column", (F.col("__rows") - F.col("present")).alias("nulls"), "__rows")
    percent = F.try_divide(F.col("nulls") * F.lit(100.0), F.col("__rows"))
    return long.select("column", "nulls", percent.alias("percent")).orderBy(F.desc("nulls"), "column")


def drop_sparse_columns(
    df: DataFrame, threshold: float = 80.0, facts: ColumnFacts | None = None, find_dates: bool = False
) -> DataFrame:
    """Drop columns with strictly more than ``threshold`` percent nulls; with ``find_dates`` as they are once dates are read."""
    return df.drop(*(facts or column_facts(df)).sparse(threshold, find_dates))


def localize_dates(df: DataFrame, zone: str, facts: ColumnFacts | None = None) -> DataFrame:
    """Text columns that hold a date become UTC timestamps shown on the wall clock of ``zone``."""
    found = (facts or column_facts(df, find_dates=True)).dates
    moved = {c: times.to_zone(times.parse_wall_time(_name(c)), zone) for c in found}
    return df.withColumns(moved) if moved else df


# Imputation ---------------------------------------------------------------------------------

def mode_of(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value, the lowest one on a tie; no row if there is none.

    Counts are combined in every task before the shuffle and the winner is a top-1, so neither a
    hot value nor many distinct ones pile up in one task.
    """
    field = df.schema[column]
    counts = df.where(~missing(field)).groupBy(_name(column).alias("value")).agg(F.count(F.lit(1)).alias("times"))
    return counts.orderBy(F.desc("times"), F.asc("value")).limit(1).select("value")


#: Most frequent values counted exactly per column, and values that the sketch of a column follows.
CANDIDATES, FOLLOWED = 16, 3072
#: A value that the sketch does not give is no more frequent than this share of the rows: twice the sketch's largest error.
UNSEEN = 2 * 3.5 / 4096


def _candidates(df: DataFrame, fields: Sequence[T.StructField]) -> tuple[int, list[list[tuple]]]:
    """Rows, and for each column its most frequent values as a sketch has them, each with a bound that its count does not pass."""
    top = [
        F.call_function("approx_top_k", F.when(~missing(f), _name(f.name)), F.lit(CANDIDATES + 1), F.lit(FOLLOWED)).alias(f"t{i}")
        for i, f in enumerate(fields)
    ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *top).first()
    return row["rows"], [[tuple(x) for x in row[f"t{i}"] or [] if x[0] is not None] for i, _ in enumerate(fields)]


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """The mode of each column, the lowest value on a tie, from two passes for all columns together.

    A sketch gives the candidates of every column; their counts are then taken exactly, without a shuffle of values. The most
    frequent candidate is the mode if its count passes what any other value can have; for a column where that is not proven, as one of
    nearly distinct values, all values are counted (``mode_of``).
    """
    plain = (T.NumericType, T.StringType, T.BooleanType)
    fields = [df.schema[c] for c in columns if isinstance(df.schema[c].dataType, plain)]
    found: dict[str, Column] = {}
    if fields:
        rows, listed = _candidates(df, fields)
        wanted = [(f, i, j, value) for i, f in enumerate(fields) for j, (value, _) in enumerate(listed[i])]
        exact = df.agg(*[
            F.count_if(_name(f.name) == F.lit(value).cast(f.dataType)).alias(f"c{i}_{j}") for f, i, j, value in wanted
        ]).first() if wanted else {}
        for i, f in enumerate(fields):
            if not listed[i]:
                if not rows:
                    found[f.name] = F.lit(None).cast(f.dataType)
                continue
            others = max(listed[i][-1][1] if len(listed[i]) >= CANDIDATES else 0, UNSEEN * rows)
            counted = [(exact[f"c{i}_{j}"], value) for j, (value, _) in enumerate(listed[i])]
            most = max(n for n, _ in counted)
            if most > others:
                found[f.name] = F.lit(min(value for n, value in counted if n == most)).cast(f.dataType)
    return {c: found[c] if c in found else mode_of(df, c).scalar() for c in columns}


def impute_mode(df: DataFrame, columns: Iterable[str], lazily: bool = False) -> DataFrame:
    """Null becomes the mode of its column; an all-null column stays null. ``lazily`` starts no job and counts all values."""
    columns = list(columns)
    found = {c: mode_of(df, c).scalar() for c in columns} if lazily else modes(df, columns)
    return df.withColumns({c: F.when(missing(df.schema[c]), mode).otherwise(_name(c)) for c, mode in found.items()})


def fill_zero(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Null becomes 0, False or '0' by type; timestamps, arrays and bytes stay null."""

    def of(kind: type) -> list[str]:
        return [f"`{f.name}`" for f in df.schema if isinstance(f.dataType, kind) and f.name not in skip]

    for kind, zero in ((T.NumericType, 0), (T.BooleanType, False), (T.StringType, "0")):
        if of(kind):
            df = df.na.fill(zero, of(kind))
    return df


def normalize_flag(df: DataFrame, columns: Sequence[str], legacy_zero: bool = False, votes: DataFrame | None = None) -> DataFrame:
    """'True'/'False' text or boolean to boolean, null to the mode of the known values.

    ``legacy_zero`` counts a null as one more value in the vote, as older outputs do: False in a
    boolean column (where a True majority then turns every value True), '0' in a text column.
    ``votes`` may hold these columns of the rows apart, where they are cheaper to read.
    """
    result, voters = {}, df if votes is None else votes
    for c in columns:
        kind, value = df.schema[c].dataType, _name(c)
        if not legacy_zero:
            flags = voters.select(text.as_flag(value).alias(c))
            result[c] = F.coalesce(text.as_flag(value), mode_of(flags, c).scalar())
        elif isinstance(kind, T.BooleanType):
            cast = voters.select(F.coalesce(value, F.lit(False)).alias(c))
            result[c] = F.coalesce(value, F.lit(False)) | mode_of(cast, c).scalar()
        else:
            cast = voters.select(F.coalesce(value.cast("string"), F.lit("0")).alias(c))
            result[c] = text.as_flag(F.coalesce(value.cast("string"), mode_of(cast, c).scalar()))
    return df.withColumns(result)


# Duplicates and types -----------------------------------------------------------------------

def comparable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric, boolean and time columns: the ones duplicates are judged by."""
    kinds = (T.NumericType, T.BooleanType, T.TimestampNTZType, T.TimestampType, T.DateType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def drop_duplicates_first(df: DataFrame, subset: Sequence[str], order: Sequence[Column], ordered: Sequence[str]) -> DataFrame:
    """First row per combination of ``subset`` under a total order that starts with ``order``.

    ``ordered`` names the columns ``order`` uses.
    """
    return keep_one(df, subset, total_order(df, order, [*subset, *ordered]))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts for the columns present; fractions are cut off on the way to an integer."""
    # unreadable text has no boolean value, everything else converts or raises
    convert = {"boolean": "try_cast"}
    have = set(df.columns)
    return df.withColumns(
        {c: F.expr(f"{convert.get(t, 'cast')}(`{c}` AS {t})") for c, t in types.items() if c in have}
    )


def shift_timestamps(df: DataFrame, columns: Sequence[str], milliseconds: int) -> DataFrame:
    shifted = {c: times.shift(_name(c), milliseconds) for c in columns}
    return df.withColumns(shifted) if shifted else df


def without_zones(df: DataFrame) -> DataFrame:
    zoned = {f.name: times.without_zone(_name(f.name)) for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(zoned) if zoned else df
