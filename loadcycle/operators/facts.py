"""What a layer's later steps must know of all its rows, counted while the layer is written.

The counters ride on the write as an ``Observation``: they cost no pass of their own, and each text value is parsed once for all
of them. They lie beside the table and those of several parts add up, so a layer that grows by days is never read again
for them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.functions import times
from loadcycle.operators import ordered
from loadcycle.sources import scratch

#: Name of the file beside a table. Readers pass over names that begin like this.
FILE = "_facts.json"


@dataclass(frozen=True)
class ColumnFacts:
    """Counters over all rows of a table or of a part of it.

    ``present``   values that are there, by column
    ``parsed``    values that can be read as a time, by text column
    ``dated``     text columns in which some value holds a date
    ``sketches``  quantile sketches of columns that later steps slice by, as base64
    """

    rows: int = 0
    present: Mapping[str, int] = field(default_factory=dict)
    parsed: Mapping[str, int] = field(default_factory=dict)
    dated: tuple[str, ...] = ()
    sketches: Mapping[str, str] = field(default_factory=dict)

    @property
    def dates(self) -> tuple[str, ...]:
        """Text columns that become times."""
        return tuple(c for c in self.present if c in self.dated)

    def nulls(self, find_dates: bool = True) -> dict[str, int]:
        """Gaps by column. Unreadable text is a gap in a column that becomes a time."""
        there = {c: self.parsed[c] if find_dates and c in self.dated else n for c, n in self.present.items()}
        return {c: self.rows - n for c, n in there.items()}

    def sparse(self, threshold: float = 80.0, find_dates: bool = True) -> list[str]:
        """Columns with strictly more than ``threshold`` percent nulls."""
        return [c for c, n in self.nulls(find_dates).items() if n * 100 > threshold * self.rows]

    def plus(self, other: ColumnFacts, spark: SparkSession) -> ColumnFacts:
        """The facts of both parts together; a column that one part lacks is all gaps there."""
        def added(a: Mapping[str, int], b: Mapping[str, int]) -> dict[str, int]:
            return {c: a.get(c, 0) + b.get(c, 0) for c in {**a, **b}}

        both = {**self.sketches, **other.sketches}
        for column in self.sketches.keys() & other.sketches.keys():
            both[column] = ordered.merged_sketch(spark, self.sketches[column], other.sketches[column])
        dated = tuple(dict.fromkeys((*self.dated, *other.dated)))
        return ColumnFacts(
            self.rows + other.rows, added(self.present, other.present), added(self.parsed, other.parsed), dated, both
        )


def _present(f: T.StructField) -> Column:
    """Number of values that are there."""
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.expr(f"count(nullif(`{f.name}`, CAST('NaN' AS DOUBLE)))")
    return F.expr(f"count(`{f.name}`)")


class Counter:
    """The aggregates for a schema, and the facts they give.

    ``slice_by`` names the columns whose quantiles later steps ask for.
    """

    def __init__(self, schema: T.StructType, find_dates: bool = True, slice_by: Sequence[str] = ()):
        self._fields = list(schema)
        self._texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)] if find_dates else []
        self._slice_by = [f for f in schema if f.name in slice_by]

    def counts(self) -> list[Column]:
        """Rows, values that are there, and sketches."""
        found = [F.count(F.lit(1)).alias("rows")]
        found += [_present(f).alias(f"n{i}") for i, f in enumerate(self._fields)]
        return found + [ordered.sketch(f).alias(f"q{i}") for i, f in enumerate(self._slice_by)]

    def dates(self) -> list[Column]:
        """What the texts hold of dates."""
        found = []
        for i, c in enumerate(self._texts):
            text = F.col(f"`{c}`")
            found.append(F.bool_or(times.looks_like_date(text)).alias(f"d{i}"))
            found.append(F.count(times.parse_wall_time(F.when(times.may_be_time(text), text))).alias(f"p{i}"))
        return found

    def aggregates(self) -> list[Column]:
        return [*self.counts(), *self.dates()]

    def facts(self, row: Row | Mapping[str, object]) -> ColumnFacts:
        return ColumnFacts(
            row["rows"],
            {f.name: row[f"n{i}"] for i, f in enumerate(self._fields)},
            {c: row[f"p{i}"] for i, c in enumerate(self._texts)},
            tuple(c for i, c in enumerate(self._texts) if row[f"d{i}"]),
            {f.name: base64.b64encode(bytes(row[f"q{i}"])).decode() for i, f in enumerate(self._slice_by) if row[f"q{i}"] is not None},
        )


def column_facts(df: DataFrame, find_dates: bool = False, slice_by: Sequence[str] = ()) -> ColumnFacts:
    """The facts of rows that were written without them: one aggregate, one row back."""
    counter = Counter(df.schema, find_dates, slice_by)
    return counter.facts(df.agg(*counter.aggregates()).first())


class Observed:
    """Rows that are counted when they are written: write ``rows``, then ask for ``facts()``.

    Counts and dates are observed apart, since Spark updates all counters of an observation by one function, which may be too long to be compiled.
    """

    def __init__(self, df: DataFrame, slice_by: Sequence[str] = ()):
        self._counter = Counter(df.schema, True, slice_by)
        self._seen = [(Observation(), found) for found in (self._counter.counts(), self._counter.dates()) if found]
        self.rows = df
        for seen, found in self._seen:
            self.rows = self.rows.observe(seen, *found)

    def facts(self) -> ColumnFacts:
        return self._counter.facts({name: value for seen, _ in self._seen for name, value in seen.get.items()})


def save(spark: SparkSession, path: str, found: ColumnFacts) -> None:
    """Puts the facts beside the table in ``path``."""
    scratch.write_text(spark, f"{path.rstrip('/')}/{FILE}", json.dumps(asdict(found)))


def load(spark: SparkSession, path: str) -> ColumnFacts | None:
    """The facts beside a table, if it was written with them."""
    told = scratch.read_text(spark, f"{path.rstrip('/')}/{FILE}")
    return None if told is None else ColumnFacts(**{k: tuple(v) if k == "dated" else v for k, v in json.loads(told).items()})
