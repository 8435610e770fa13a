"""READY time of an equipment between two instants, from a log of state changes.

A state holds from its start to the start of the equipment's next state; the last one holds on.
READY time up to an instant t grows by t while READY, so it is  r(t) * t - (sum of d * start)  over
the changes up to t, where d is +1 for a change into READY, -1 for one out of it, and r(t) their
sum. That needs running sums only: no interval is paired with an instant, and the work is linear in
states plus instants however long the intervals are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.functions import times
from loadcycle.operators.ordered import Bounds, previous_in_group, running_sums


def ready_changes(
    states: DataFrame, group: str, start: str, ready: str, tie: str, bounds: Bounds | None = None
) -> DataFrame:
    """Instants (microseconds) at which a group turns READY (+1) or stops being READY (-1).

    Of several states that start together only the last one by ``tie`` lasts; the others collapse
    in an aggregate before the shuffle.
    """
    log = states.where(F.col(start).isNotNull() & F.col(group).isNotNull()).select(
        F.col(group).alias("group"),
        times.micros(F.col(start)).alias("at"),
        F.col(tie).alias("tie"),
        F.coalesce(F.col(ready), F.lit(False)).cast("long").alias("now"),
    )
    log = log.groupBy("group", "at").agg(F.max_by("now", "tie").alias("now"))
    log = previous_in_group(log, "now", ["group"], ["at"], "before", bounds)
    change = F.col("now") - F.coalesce(F.col("before"), F.lit(0))
    return log.select("group", "at", change.alias("turn")).where(F.col("turn") != 0)


def ready_clock(changes: DataFrame, instants: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """READY microseconds of a group up to an instant, for distinct ``instants`` (columns group, at)."""
    turns = changes.select("group", "at", "turn", (F.col("turn") * F.col("at")).alias("turned"), F.lit(False).alias("asked"))
    zero = F.lit(0).cast("long")
    asked = instants.select("group", "at", zero.alias("turn"), zero.alias("turned"), F.lit(True).alias("asked"))
    summed = running_sums(asked.unionByName(turns), ["turn", "turned"], ["group"], ["at", "asked"], bounds)
    clock = F.col("turn") * F.col("at") - F.col("turned")
    return summed.where("asked").select("group", "at", clock.alias("clock"))


def ready_seconds(
    df: DataFrame,
    changes: DataFrame,
    row_id: str,
    group: str,
    spans: Mapping[str, tuple[str, str]],
    bounds: Bounds | None = None,
) -> DataFrame:
    """One column per span ``{name: (from, to)}`` with the READY seconds of the row's group in it.

    ``row_id`` is unique. A span without both ends, or without a group, is null; one that ends
    before it starts is 0. Clocks are worked out once per distinct group and instant.
    """
    moments: Sequence[str] = sorted({m for span in spans.values() for m in span})
    points = F.array(*[F.struct(F.lit(m).alias("point"), times.micros(F.col(m)).alias("at")) for m in moments])
    instants = (
        df.where(F.col(group).isNotNull())
        .select(F.col(row_id).alias("row_id"), F.col(group).alias("group"), F.explode(points).alias("p"))
        .select("row_id", "group", "p.point", "p.at")
        .where(F.col("at").isNotNull())
    )
    clocks = ready_clock(changes, instants.select("group", "at").distinct(), bounds)
    per_row = instants.join(clocks, ["group", "at"]).groupBy("row_id").agg(
        *[F.max(F.when(F.col("point") == m, F.col("clock"))).alias(f"__{m}") for m in moments]
    )

    def seconds(since: str, to: str):
        both = F.col(f"__{since}").isNotNull() & F.col(f"__{to}").isNotNull()
        return F.when(both, F.greatest(F.col(f"__{to}") - F.col(f"__{since}"), F.lit(0)) / F.lit(1e6))

    found = per_row.select("row_id", *[seconds(*span).alias(name) for name, span in spans.items()])
    return df.join(found, F.col(row_id) == F.col("row_id"), "left").drop("row_id")
