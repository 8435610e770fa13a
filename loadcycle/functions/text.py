"""Values that arrive as text, bytes or arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def as_text(value: Column, kind: T.DataType) -> Column:
    """Text form of a text, bytes or array column (bytes are UTF-8)."""
    if isinstance(kind, T.BinaryType):
        return F.decode(value, "UTF-8")
    if isinstance(kind, T.ArrayType):
        return F.array_join(value.cast("array<string>"), ",")
    return value.cast("string")


def element_count(value: Column, kind: T.DataType) -> Column:
    """Elements of an array, or of an array written as ``{1,2,3}``; 0 for null and for empty."""
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(value), F.lit(0)).cast("long")
    if isinstance(kind, (T.BinaryType, T.StringType)):
        inner = F.btrim(as_text(value, kind), F.lit("{}"))
        return F.when(inner != "", F.size(F.split(inner, ","))).otherwise(F.lit(0)).cast("long")
    return F.lit(0).cast("long")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda done, x: done + F.coalesce(F.abs(x), F.lit(0.0)))


def pass_tonnage(value: Column, kind: T.DataType, legacy_digits: bool = False) -> Column:
    """Sum of the numbers in a list of tenths of a tonne, in tonnes; 0 for null. Signs do not count.

    ``legacy_digits`` treats a decimal point as noise (60.5 counts as 605), as older outputs do.
    """
    if isinstance(kind, T.ArrayType) and not legacy_digits:
        numbers = value.cast("array<double>")
    elif legacy_digits:
        if isinstance(kind, T.ArrayType):
            # whole numbers print as "600." there, so their fraction adds no digit
            text = F.array_join(F.transform(value.cast("array<string>"), lambda x: F.regexp_replace(x, r"\.0$", "")), ",")
        else:
            text = as_text(value, kind)
        digits = F.regexp_replace(F.replace(text, F.lit(" "), F.lit(",")), r"[^\d,]", "")
        filled = F.filter(F.split(digits, ","), lambda x: x != "")
        numbers = F.transform(filled, lambda x: x.cast("double"))
    else:
        found = F.regexp_extract_all(as_text(value, kind), F.lit(_NUMBER), F.lit(0))
        numbers = F.transform(found, lambda x: x.cast("double"))
    return F.coalesce(_total(numbers), F.lit(0.0)) / F.lit(10.0)


def as_flag(value: Column) -> Column:
    """'True'/'False' text, number or boolean to boolean; unreadable text to null."""
    return value.try_cast("boolean")


def replace_values(value: Column, mapping: dict) -> Column:
    """Swap the listed values, keep the others."""
    result = value
    for old, new in mapping.items():
        result = F.when(value == F.lit(old), F.lit(new)).otherwise(result)
    return result
