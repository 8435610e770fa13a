"""The daily run: one more day of cycles, without working out the days before again.

The raw layer is kept by arrival day, the timed loads by the day on which loading starts. What a day leaves to the next one lies
in small tables: of each machine the last load and the last state, and of each day the ids that arrived. An earlier day is
worked out again only if the new day brings a load of one of its cycles or a newer row of one of its ids. All parts
that change are committed at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcycle.operators import facts
from loadcycle.operators.ordered import slice_bounds
from loadcycle.operators.relational import alive, by_content, keep_one, strictly_between
from loadcycle.plans import raw
from loadcycle.plans.presentation import presentation
from loadcycle.plans.stage import SLICE_BY, StageOptions, stage_cycles
from loadcycle.sources import versions
from loadcycle.sources.scratch import cut, own_scratch, together

_START, _END, _MACHINE = raw._START, raw._END, "id_equipo_carguio"


def _day(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d")


def _bounds(day: str) -> tuple:
    """Strict bounds of a day, midnight included."""
    first = _day(day)
    return [F.lit(x).cast("timestamp_ntz") for x in (first - dt.timedelta(microseconds=1), first + dt.timedelta(days=1))]


def _arrivals(tables: Mapping[str, DataFrame], day: str) -> DataFrame:
    return strictly_between(alive(tables["tp_cargadescarga"]), "tiem_llegada", *_bounds(day))


def _as_lags(carried: DataFrame) -> DataFrame:
    """The machines' last loads as rows before the day's own."""
    return carried.select(_MACHINE, _START, _END, "load_id").withColumn("__carried", F.lit(True))


def day_loads(tables: Mapping[str, DataFrame], day: str, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The loads that start on a day with the one before of each machine, and of each machine the last load by its end."""
    joined = cut(raw.joined_loads(tables, *_bounds(day)), "day-loads")
    rows = joined.withColumn("__carried", F.lit(False))
    if carried is not None:
        rows = rows.unionByName(_as_lags(carried), allowMissingColumns=True)
    bounds = slice_bounds(rows, [_START, "load_id"])
    lagged = raw.previous_in_group(rows, _END, [_MACHINE], [_START, "load_id"], "previous_esperando_pala", bounds)
    lagged = lagged.where(~F.col("__carried")).drop("__carried")
    last = rows.groupBy(_MACHINE).agg(
        F.max_by(F.struct(_START, _END, "load_id"), F.struct(_START, "load_id", by_content(rows.drop("__carried")))).alias("s")
    )
    return lagged, last.select(_MACHINE, f"s.{_START}", f"s.{_END}", "s.load_id")


def _state_before(spark: SparkSession, path: str, moment: dt.datetime | None) -> tuple:
    """The newest midnight before an instant at which the machines' states were kept, and these states."""
    kept = [d for d in versions.current(spark, path).parts if moment is not None and _day(d) <= moment]
    if not kept:
        return None, None
    return F.lit(_day(max(kept))).cast("timestamp_ntz"), versions.read(spark, path, [max(kept)])


class Layers:
    """The tables of the daily run below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, folder = spark, folder.rstrip("/")
        self.raw, self.loads, self.ids, self.last_loads, self.last_states, self.stage, self.presentation = (
            f"{folder}/{name}" for name in ("raw", "loads", "ids", "last-loads", "last-states", "stage", "presentation")
        )

    def days(self) -> list[str]:
        return sorted(versions.current(self.spark, self.ids).parts)

    def facts(self) -> facts.ColumnFacts:
        """What the stage must know of all days: the sum of what was counted as each was written."""
        whole = facts.ColumnFacts()
        for _, told in sorted(versions.current(self.spark, self.raw).told.items()):
            whole = whole.plus(facts.ColumnFacts(**{**told, "dated": tuple(told["dated"])}), self.spark)
        return whole


def days_to_redo(layers: Layers, ids: DataFrame, loads: DataFrame, day: str) -> list[str]:
    """Earlier days with a cycle that the new day's loads belong to, or an id that arrived again. Days come back, no rows."""
    spark = layers.spark
    earlier = [d for d in layers.days() if d < day]
    if not earlier:
        return []
    known = versions.read(spark, layers.ids, earlier)
    back = ids.select(F.col("id").alias("__back")).distinct()
    again = known.join(back, F.col("id").eqNullSafe(F.col("__back")), "left_semi")  # rows without an id are one cycle, as in one run
    loaded = known.join(loads.select("id_palas").distinct(), "id_palas", "left_semi")
    found = again.select("day").unionByName(loaded.select("day")).distinct()
    return sorted(r["day"] for r in found.collect())


def refresh(tables: Mapping[str, DataFrame], folder: str, day: str, integer_division: bool = False) -> list[str]:
    """Adds a day (``YYYY-MM-DD``) to the raw layer, or works the last one out again; gives the days that changed.

    Days come in order: what a day leaves to the next is known for the last one only. The raw layer is committed first and what later
    days need after it, so a run that fails between the two is mended by running the day again.
    """
    spark = next(iter(tables.values())).sparkSession
    layers, midnight = Layers(spark, folder), _day(day)
    known = layers.days()
    if known and day < known[-1]:
        raise ValueError(f"{known[-1]} was added already; days come in order")
    before = [d for d in known if d < day]

    with own_scratch(spark):
        carried = versions.read(spark, layers.last_loads, [before[-1]]) if before else None
        types, machines = together(
            spark, lambda: cut(raw.state_types(tables), "state-types"), lambda: cut(raw.machines_named(tables), "machines")
        )
        lagged, last = day_loads(tables, day, carried)
        arrived = cut(_arrivals(tables, day).select("id", "id_palas", F.lit(day).alias("day")), "arrivals")
        states, loads = together(
            spark,
            lambda: cut(raw.current_states(tables, types), "states"),
            lambda: cut(raw.chosen_loads(lagged).withColumn("choice", by_content(lagged)), "loads"),
        )
        first, end = raw.span_asked(loads)
        since, held = _state_before(spark, layers.last_states, first)
        changes, by_state = raw.ready_log(
            tables, types, *[F.lit(x).cast("timestamp_ntz") for x in (first, end)], since=since, carried=held
        )
        timed = cut(raw.timed_loads(loads, changes, slice_bounds(loads, [_START, "load_id"]).merged(by_state)), "timed-loads")

        # the tables that later days need; nothing is seen before the commits at the end
        kept = {
            layers.loads: (timed, day), layers.ids: (arrived, day), layers.last_loads: (last, day),
            layers.last_states: (_states_at(tables, spark, layers, midnight), day),
        }
        staged = {path: (versions.stage_part(rows, path, part), part, rows.schema) for path, (rows, part) in kept.items()}
        redo = days_to_redo(layers, arrived, timed, day)
        every_load = timed
        if before:
            every_load = versions.read(spark, layers.loads, before).unionByName(timed)
        every_id = versions.read(spark, layers.ids, before).unionByName(arrived) if before else arrived

        parts, told, schema = {}, {}, None
        for changed in [*redo, day]:
            period = _arrivals(tables, changed)
            later = every_id.where(F.col("day") > changed).select(F.col("id").alias("__later")).distinct()
            cycles = raw.newest_cycles(tables, period).join(later, F.col("id").eqNullSafe(F.col("__later")), "left_anti")
            asked = every_load.join(period.select("id_palas").distinct(), "id_palas", "left_semi")
            loading = keep_one(asked, ["id_palas"], [F.col("load_id").desc(), F.col("choice")]).drop("choice")
            observed = facts.Observed(raw.wide_cycles(tables, period, cycles, loading, machines, states, integer_division), SLICE_BY)
            parts[changed] = versions.stage_part(observed.rows, layers.raw, changed)
            told[changed], schema = vars(observed.facts()), observed.rows.schema
        versions.commit(spark, layers.raw, parts, schema, told)
        for path, (part_folder, part, own) in staged.items():
            versions.commit(spark, path, {part: part_folder}, own)
    return [*redo, day]


def _states_at(tables: Mapping[str, DataFrame], spark: SparkSession, layers: Layers, midnight: dt.datetime) -> DataFrame:
    """Of each machine the last state that began before midnight, from those kept a day ago and the log since."""
    since, held = _state_before(spark, layers.last_states, midnight - dt.timedelta(days=1))
    log = alive(tables["tp_estados"]).select(*raw._STATE).where(F.col("tiempo_inicio") < F.lit(midnight).cast("timestamp_ntz"))
    if held is not None:
        log = log.where(F.col("tiempo_inicio") >= since).unionByName(held.select(*raw._STATE))
    return raw.last_states(log)


def run(tables: Mapping[str, DataFrame], folder: str, day: str, options: StageOptions = StageOptions()) -> DataFrame:
    """A day more in all three layers; returns the presentation table.

    The stage fills gaps with values of all rows, so it is made anew from the raw layer, by facts that no pass takes.
    """
    refresh(tables, folder, day)
    layers = Layers(next(iter(tables.values())).sparkSession, folder)
    with own_scratch(layers.spark):
        staged = stage_cycles(versions.read(layers.spark, layers.raw), options, layers.facts())
        stage = versions.replace(staged, layers.stage)
    return versions.replace(presentation(stage), layers.presentation)
