"""Raw layer: one wide row per haul cycle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.functions import numbers
from loadcycle.operators import intervals
from loadcycle.operators.ordered import Bounds, previous_in_group, slice_bounds
from loadcycle.operators.relational import (
    alive,
    by_content,
    keep_one,
    latest_per_key,
    left_join_spreading_nulls,
    names_up_the_tree,
    one_per_key,
    strictly_between,
    three_level_tree,
    with_keys_of,
)
from loadcycle.plans import fixed_values as fixed
from loadcycle.sources.scratch import cut, together

_START, _END = "tiempo_inicio_carga_carguio", "tiempo_esperando_carguio"


def equipment(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Equipment with both fleet levels above it."""
    nodes = alive(tables["ts_equipos"])
    return one_per_key(three_level_tree(nodes, "id", "id_flota", "nombre", "isflota"), "id")


def machines_named(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The equipment that cycles or shovel versions name, so that the wide rows meet a small table however many there are."""
    named = [tables[t].select(F.col("id_equipo").alias("__named")).distinct() for t in ("tp_cargadescarga", "tp_palas")]
    return equipment(tables).join(named[0].unionByName(named[1]).distinct(), F.col("id") == F.col("__named"), "left_semi")


def state_types(tables: Mapping[str, DataFrame]) -> DataFrame:
    """State details with the names of the two levels above."""
    tree = tables["ts_detal_estado"]
    leaves = tree.select("id_detal_estado", "id_tipo_estad", F.col("nombre").alias("estado_detalle"))
    named = names_up_the_tree(
        leaves, tree, "id", "id_tipo_estad", "nombre", "id_tipo_estad", "estado_secundario", "estado_primario"
    )
    return one_per_key(named, "id_detal_estado")


def current_states(tables: Mapping[str, DataFrame], types: DataFrame) -> DataFrame:
    """Latest state of every equipment: by start, then by id."""
    log = alive(tables["tp_estados"]).where(F.col("id_equipo").isNotNull()).select(
        "id",
        "id_estados",
        "id_equipo",
        "id_detal_estado",
        F.col("tiempo_inicio").alias("tiempo_inicio_cambio_estado"),
        F.col("tiempo_estimado").alias("tiempo_estimado_duracion_estado"),
        F.col("idenestado").alias("en_campo_o_taller_mantenimiento"),
        "tipoubicacionsupervisor",
    )
    newest = [F.col("tiempo_inicio_cambio_estado").desc_nulls_last(), F.col("id").desc_nulls_last(), by_content(log)]
    return keep_one(log, ["id_equipo"], newest).join(types, "id_detal_estado", "left")


_STATE = ["id", "id_equipo", "id_detal_estado", "tiempo_inicio"]


def last_states(log: DataFrame) -> DataFrame:
    """Of each machine the state that began last."""
    newest = F.max_by(F.struct("id", "id_detal_estado", "tiempo_inicio"), F.struct("tiempo_inicio", "id")).alias("s")
    held = log.where(F.col("id_equipo").isNotNull()).groupBy("id_equipo").agg(newest)
    return held.select("s.id", "id_equipo", "s.id_detal_estado", "s.tiempo_inicio")


def states_that_count(tables: Mapping[str, DataFrame], first, last, since=None, carried: DataFrame | None = None) -> DataFrame:
    """States that can hold between two instants: of those before the first, the last one per machine.

    ``carried`` may hold the machines' states at an earlier instant ``since``; the log is then read from there on.
    """
    log = alive(tables["tp_estados"]).select(*_STATE)
    if carried is not None:
        log = log.where(F.col("tiempo_inicio") >= since).unionByName(carried.select(*_STATE))
    within = log.where((F.col("tiempo_inicio") >= first) & (F.col("tiempo_inicio") <= last))
    return within.unionByName(last_states(log.where(F.col("tiempo_inicio") < first)))


def ready_log(tables: Mapping[str, DataFrame], types: DataFrame, first, last, since=None, carried=None) -> tuple[DataFrame, Bounds]:
    """Instants at which an equipment turns READY or stops being READY, as far as the span asked needs them."""
    kinds = types.select("id_detal_estado", (F.col("estado_primario") == "READY").alias("ready"))
    log = cut(states_that_count(tables, first, last, since, carried), "states-asked")
    bounds = slice_bounds(log, ["tiempo_inicio"])
    log = log.join(kinds, "id_detal_estado", "left")
    return cut(intervals.ready_changes(log, "id_equipo", "tiempo_inicio", "ready", "id", bounds), "ready-changes"), bounds


def joined_loads(tables: Mapping[str, DataFrame], low, high) -> DataFrame:
    """Loads that start between the bounds, each with the newest version of its shovel cycle.

    They come from the plain table: a cycle that arrived outside the period still loads inside it.
    """
    loads = strictly_between(alive(tables["tp_cargadescarga"]), "tiem_carga", low, high)
    loads = loads.where(F.col("tiem_viajando").isNotNull() & F.col("id_palas").isNotNull()).select(
        F.col("id").alias("load_id"), "id_palas", F.col("tiem_carga").alias(_START), F.col("tiem_acarreo").alias(_END)
    )
    asked = with_keys_of(tables["tp_palas"], "id_palas", loads, "id_palas")
    versions = alive(latest_per_key(asked, "id_palas", "id")).select(
        F.col("id_palas"),
        F.col("id").alias("id_ciclo_carguio"),
        F.col("id_equipo").alias("id_equipo_carguio"),
        "id_locacion",
        "id_poligono",
        "id_trabajador",
        "id_crew",
        "isspot",
        "bool_estado",
        "bool_equipo_next",
        "cola",
    )
    return loads.join(versions, "id_palas")


def shovel_loads(loads: DataFrame, bounds: Bounds) -> DataFrame:
    """Loading side of the cycles, one row per ``id_palas``, from the written ``joined_loads``.

    A deleted newest version takes the load out. Of several loads on one ``id_palas`` the one with the highest
    cycle id stays. The choice is made here, before the join with the cycles, so that join cannot multiply rows.
    """
    loads = previous_in_group(
        loads, _END, ["id_equipo_carguio"], [_START, "load_id"], "previous_esperando_pala", bounds
    )
    return chosen_loads(loads)


def chosen_loads(loads: DataFrame) -> DataFrame:
    """Of the loads of one ``id_palas`` the one with the highest cycle id."""
    return keep_one(loads, ["id_palas"], [F.col("load_id").desc(), by_content(loads)])


def timed_loads(loads: DataFrame, changes: DataFrame, bounds: Bounds) -> DataFrame:
    """READY seconds while loading, and while waiting since the machine's previous load."""
    spans = {"tiempo_ready_cargando": (_START, _END), "tiempo_ready_esperando": ("previous_esperando_pala", _START)}
    return intervals.ready_seconds(loads, changes, "id_palas", "id_equipo_carguio", spans, bounds)


def span_asked(loads: DataFrame) -> tuple:
    """The first and the last instant between which READY time of these loads is asked."""
    instants = F.array(*[F.col(c) for c in ("previous_esperando_pala", _START, _END)])
    row = loads.agg(F.min(F.array_min(instants)).alias("first"), F.max(F.array_max(instants)).alias("last")).first()
    return row["first"], row["last"]


#: The cycle id as a join key that a row without an id has as well.
_KEY = ["__key", "__none"]

#: Columns of a cycle that stay beside its packed row, since choices and joins look at them.
_BESIDE = ["id", "id_palas", "id_cargadescarga", "tiem_llegada", "id_turnocarga", "id_turnodescarga"]


def _wanted(role: str) -> list[str]:
    """Columns of a role that the raw row shows."""
    sources = [source.split(".") for source in fixed.RAW_COLUMNS.values()]
    return list(dict.fromkeys(column for owner, column in sources if owner == role))


def _packed(df: DataFrame, role: str, key: str = "id") -> DataFrame:
    """The key as ``__role`` and what the raw row shows of it as one value, which joins copy whole instead of column by column."""
    return df.select(F.col(key).alias(f"__{role}"), F.struct(*_wanted(role)).alias(role))


def factors(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The highest factor of each id."""
    known = tables["ta_factortonelaje"].where(F.col("id").isNotNull() & F.col("factor").isNotNull())
    return keep_one(known, ["id"], [F.col("factor").desc(), by_content(known)])


def _cycle_rows(tables: Mapping[str, DataFrame], period: DataFrame) -> DataFrame:
    """The cycles packed, with their factor. One without a factor has neither, so that little of it is moved."""
    rows = period.withColumn("__content", by_content(period))
    rows = rows.join(_packed(factors(tables), "factor"), F.col("id_factor") == F.col("__factor"), "left")
    shown = F.struct(*[c for c in _wanted("cycle") if c not in _BESIDE])
    return rows.select(*_BESIDE, "__content", "factor", F.when(F.col("factor").isNotNull(), shown).alias("cycle"))


def newest_cycles(tables: Mapping[str, DataFrame], period: DataFrame) -> DataFrame:
    """One row per cycle id that has a factor: the newest arrival, packed. The key columns are added.

    An id whose newest arrival has no factor goes, whatever its older ones have.
    """
    rows = _cycle_rows(tables, period)
    newest = [F.col(c).desc_nulls_last() for c in ("tiem_llegada", "id_cargadescarga", "id_palas")]
    keyed = rows.withColumns({"__key": F.coalesce(F.col("id"), F.lit(0).cast(period.schema["id"].dataType)), "__none": F.col("id").isNull()})
    return keep_one(keyed, _KEY, [*newest, F.col("__content")]).where(F.col("factor").isNotNull()).drop("__content")


def _found_for(cycles: DataFrame, key: str, right: DataFrame, role: str) -> DataFrame:
    """``right``'s row for each cycle that has one, with the cycle's key: narrow rows that the wide ones meet by cycle."""
    asked = cycles.where(F.col(key).isNotNull()).select(*[F.col(k).alias(f"__{role}{k}") for k in _KEY], F.col(key).alias("__asked"))
    return asked.join(_packed(right, role, key), F.col("__asked") == F.col(f"__{role}")).drop("__asked", f"__{role}")


def _attached(wide: DataFrame, cycles: DataFrame, key: str, right: DataFrame, role: str) -> DataFrame:
    """The cycles with ``right``'s row, found by a key of the cycle.

    Cycles by id stay where they are and the rows found for them come by id. Where ids may repeat the wide rows move.
    """
    if _KEY[0] not in cycles.columns:
        return left_join_spreading_nulls(wide, _packed(right, role, key), key, f"__{role}", "id")
    same = " AND ".join(f"{k} = __{role}{k}" for k in _KEY)
    return wide.join(_found_for(cycles, key, right, role), F.expr(same), "left")


def haul_cycles(
    tables: Mapping[str, DataFrame],
    low,
    high,
    integer_division: bool = False,
    cycle_id_is_key: bool = False,
) -> DataFrame:
    """One wide row per haul cycle that arrived strictly between the bounds and has a factor.

    ``cycle_id_is_key`` says that no cycle id repeats (a primary key); the shuffle that would drop
    repeats is then left out.

    Tables that later steps read more than once, or whose size Spark could only guess behind joins
    and windows, are written to the scratch folder first: nothing is worked out twice, and the true
    size of machines and states decides between broadcast and shuffle.
    """
    low, high = F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")
    # the period first, so that it reaches the scan and no row outside it can stand for a cycle inside
    period = strictly_between(alive(tables["tp_cargadescarga"]), "tiem_llegada", low, high)
    if cycle_id_is_key:
        cycles = _cycle_rows(tables, period).where(F.col("factor").isNotNull())
    else:
        cycles = newest_cycles(tables, period)

    spark = period.sparkSession
    types, joined = together(
        spark,
        lambda: cut(state_types(tables), "state-types"),
        lambda: cut(joined_loads(tables, low, high), "joined-loads"),
    )
    by_load = slice_bounds(joined, [_START, "load_id"])
    machines, states, loads = together(
        spark,
        lambda: cut(machines_named(tables), "machines"),
        lambda: cut(current_states(tables, types), "states"),
        lambda: cut(shovel_loads(joined, by_load), "loads"),
    )
    changes, by_state = ready_log(tables, types, *[F.lit(x).cast("timestamp_ntz") for x in span_asked(loads)])
    # the loading side is complete before the wide cycle rows meet it
    loading = timed_loads(loads, changes, by_load.merged(by_state))
    return wide_cycles(tables, period, cycles, loading, machines, states, integer_division)


def wide_cycles(
    tables: Mapping[str, DataFrame], period: DataFrame, cycles: DataFrame, loading: DataFrame, machines: DataFrame, states: DataFrame,
    integer_division: bool = False,
) -> DataFrame:
    """The packed cycles with everything that belongs to them. ``loading`` has one timed load per ``id_palas``."""
    shifts = one_per_key(alive(tables["ts_turnos"]).select("id", "id_turnos", "nombre", "horaini", "horafin"), "id")
    nodes = alive(tables["tp_nodos"])
    load_nodes = one_per_key(nodes.where("loc_carga"), "id")
    dump_nodes = one_per_key(nodes.where("loc_descarga"), "id")

    def left(df, right, role, key, right_key="id"):
        return df.join(_packed(right, role, right_key), F.col(key) == F.col(f"__{role}"), "left")

    # the two joins that move large tables come first, the small dimensions after them
    passes = with_keys_of(alive(tables["ta_datacarga_sensores"]), "id_cargadescarga", period, "id_cargadescarga")
    wide = _attached(cycles, cycles, "id_palas", loading, "shovel")
    wide = _attached(wide, cycles, "id_cargadescarga", latest_per_key(passes, "id_cargadescarga", "id"), "passes")

    wide = left(wide, one_per_key(tables["ts_locacion"], "id"), "location", "shovel.id_locacion")
    wide = left(wide, one_per_key(tables["ts_poligono"], "id"), "polygon", "shovel.id_poligono")
    wide = left(wide, load_nodes, "load_node", "location.id_nodo")
    wide = left(wide, machines, "digger", "shovel.id_equipo_carguio")
    wide = left(wide, states, "shovel_state", "shovel.id_equipo_carguio", "id_equipo")
    wide = left(wide, machines, "truck", "cycle.id_equipo")
    wide = left(wide, shifts, "load_shift", "id_turnocarga")
    wide = left(wide, shifts, "dump_shift", "id_turnodescarga")
    wide = left(wide, one_per_key(tables["ts_descarga"], "id"), "dump", "cycle.id_descarga")
    wide = left(wide, dump_nodes, "dump_node", "dump.id_nodo")
    wide = left(wide, states, "truck_state", "cycle.id_equipo", "id_equipo")

    beside = {f"cycle.{c}": c for c in _BESIDE}
    columns = [F.col(beside.get(source, source)).alias(name) for name, source in fixed.RAW_COLUMNS.items()]
    busy = F.col("shovel.tiempo_ready_cargando") + F.col("shovel.tiempo_ready_esperando")
    tonnage = F.col("cycle.tonelajevims")
    return wide.select(
        *columns,
        numbers.dry_tonnes(tonnage, F.col("factor.factor"), integer_division).alias("toneladas_secas"),
        numbers.hourly_rate(tonnage / F.lit(10.0), busy).alias("productividad_operativa_carguio_tn_h"),
        F.lit(1).cast("long").alias("rownum"),
    )
