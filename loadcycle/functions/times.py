"""Wall-clock timestamps (``timestamp_ntz``, microseconds)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a date inside a text looks like.
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_DAY_FIRST = r"^\s*(\d{2})/(\d{2})/(\d{4})"
_BEGINS_LIKE_TIME = r"^[\s\p{Cntrl}]*[0-9T+-]"
_OFFSET_AT_END = r"\d{2}:\d{2}.*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)\s*$"


def looks_like_date(text: Column) -> Column:
    return text.rlike(DATE_PATTERN)


def may_be_time(text: Column) -> Column:
    """Cheap test that every text passes which ``parse_wall_time`` can read: its first sign, blanks aside."""
    return text.rlike(_BEGINS_LIKE_TIME)


def micros(moment: Column) -> Column:
    """Microseconds since the epoch, read off the wall clock."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), moment)


def from_micros(value: Column) -> Column:
    return F.timestamp_add("MICROSECOND", value, F.expr(_EPOCH))


def parse_wall_time(text: Column) -> Column:
    """ISO or dd/MM/yyyy text to a timestamp without zone, anything else to null.

    A trailing zone offset moves the value to UTC. The result does not depend on the session zone.
    """
    iso = F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")
    in_utc = from_micros(F.unix_micros(iso.try_cast("timestamp")))
    return F.when(iso.rlike(_OFFSET_AT_END), in_utc).otherwise(iso.try_cast("timestamp_ntz"))


def to_zone(moment: Column, zone: str, source_zone: str = "UTC") -> Column:
    """The same instant on the wall clock of another zone."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), moment)


def without_zone(moment: Column) -> Column:
    """Drop the zone, keep the wall time of the session zone."""
    return moment.cast("timestamp_ntz")


def shift(moment: Column, milliseconds: int) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(milliseconds * 1000).cast("long"), moment)


def seconds_between(end: Column, start: Column) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def format_and_parse(moment: Column, pattern: str = "yyyy-MM-dd HH:mm:ss.SSSSSS") -> Column:
    """To text and back; keeps every value whose digits the pattern covers."""
    return F.date_format(moment, pattern).try_cast("timestamp_ntz")
