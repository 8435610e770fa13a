"""Rules that take implausible cycles out, and the state they leave behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_least(df: DataFrame, column: str, minimum: float | None) -> DataFrame:
    """Minimum, bound included; ``None`` switches the rule off."""
    return df if minimum is None else df.where(F.col(column) >= minimum)


def not_zero(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != 0)


def above(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) > bound)


def in_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Closed band."""
    return df.where(F.col(column).between(low, high))


def ready_state(state: Column, passes: Column, delayed: str = "DELAY", ready: str = "READY") -> Column:
    """Every state but a delay without passes counts as READY."""
    return F.when((state == delayed) & (passes <= 0), F.lit(delayed)).otherwise(F.lit(ready))


def keep_ready(df: DataFrame, state: str, passes: str) -> DataFrame:
    """Rewrite the state, then keep READY rows that have passes."""
    rewritten = df.withColumn(state, ready_state(F.col(state), F.col(passes)))
    return rewritten.where((F.col(state) == "READY") & (F.col(passes) > 0))


def when_enough(value: Column, passes: Column, minimum: int) -> Column:
    """The value where there are enough passes, null elsewhere."""
    return F.when(passes >= minimum, value)
