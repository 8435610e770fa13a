"""Arithmetic on columns: ratios that survive a zero divisor, unit changes, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dry_tonnes(tenths: Column, per_mille: Column, integer_division: bool = False) -> Column:
    """Tonnage in tenths times a factor in thousandths.

    ``integer_division`` truncates both quotients first, as a database does on two integers.
    """
    if integer_division:
        whole_tonnes = F.call_function("div", tenths.cast("long"), F.lit(10).cast("long"))
        whole_factor = F.call_function("div", per_mille.cast("long"), F.lit(1000).cast("long"))
        return whole_tonnes * whole_factor
    return (tenths / F.lit(10.0)) * (per_mille / F.lit(1000.0))


def hourly_rate(amount: Column, seconds: Column) -> Column:
    """Amount per hour; null when no time passed."""
    return F.try_divide(amount, seconds / F.lit(3600.0))


def rescale(value: Column, divisor: float) -> Column:
    return value / F.lit(float(divisor))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; null when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def distance(left: Column, right: Column) -> Column:
    return F.abs(left - right)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 when ``whole`` is zero."""
    return F.when(whole != 0, F.try_divide(part.cast("double"), whole.cast("double"))).otherwise(F.lit(0.0))


def share_of(percent: Column, capacity: Column) -> Column:
    return (percent / F.lit(100.0)) * capacity


def round_half_even(value: Column) -> Column:
    return F.bround(value, 0)
