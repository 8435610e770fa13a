"""Stage layer: cleaned, renamed and enriched cycles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcycle.functions import numbers, text, times
from loadcycle.operators import cleaning, ordered, outliers
from loadcycle.operators.facts import ColumnFacts, column_facts
from loadcycle.operators.relational import repeated_marks, split_by_marks
from loadcycle.plans import fixed_values as fixed
from loadcycle.sources.scratch import cut

#: The order in which gaps are filled.
SLICE_BY = ["id_ciclo_acarreo"]


@dataclass(frozen=True)
class StageOptions:
    """Switches between the variants of the stage layer.

    ``min_passes``      drop cycles with fewer passes (4 in the older variants, off in the newest)
    ``find_dates``      turn date-like text columns into local timestamps first
    ``legacy_digits``   read 60.5 as 605 in the pass tonnage
    ``legacy_zero``     let nulls vote when a flag's most frequent value is looked up
    ``strict``          raise when a column the steps name is absent, instead of leaving it out
    ``sparse_above``    columns with more than this percentage of nulls go
    ``zone``            wall clock of the dates found in text
    """

    min_passes: int | None = None
    find_dates: bool = True
    legacy_digits: bool = False
    legacy_zero: bool = False
    strict: bool = False
    sparse_above: float = 80.0
    zone: str = fixed.ZONE


def drop_sparse_only(raw: DataFrame, sparse_above: float = 80.0, facts: ColumnFacts | None = None) -> DataFrame:
    """Reduced stage: nothing but the sparse columns goes."""
    return cleaning.drop_sparse_columns(raw, sparse_above, facts)


def required_columns() -> list[str]:
    """Raw columns the steps name, in the order of the layer."""
    named = {*fixed.MODE_COLUMNS, *fixed.DATE_COLUMNS, *fixed.LONG_COLUMNS, *fixed.DOUBLE_COLUMNS,
             *fixed.BOOLEAN_COLUMNS, *fixed.FLAG_COLUMNS, "coord_x_pases", "tonelaje_pases", "estado_primario_pala"}
    return sorted(named)


@dataclass(frozen=True)
class _Parts:
    """The cycles in two parts: ``single`` ones, which cannot be duplicates, and the other ``kept`` ones, of which duplicates are gone.

    ``unfilled`` are the single ones before the gaps in their times are filled.
    """

    single: DataFrame
    kept: DataFrame
    unfilled: DataFrame


def _has_gaps(raw: DataFrame, column: str, facts: ColumnFacts) -> bool:
    """May the time column have gaps? Unreadable text is one."""
    there = facts.parsed.get(column, 0) if isinstance(raw.schema[column].dataType, T.StringType) else facts.present.get(column, 0)
    return there < facts.rows


def _parts(raw: DataFrame, options: StageOptions, facts: ColumnFacts | None, keep: Callable[[DataFrame, str], DataFrame] | None) -> _Parts:
    """Dates parsed, sparse columns gone, nulls filled, duplicates dropped.

    The wide rows stay where they are, but for those with a gap to fill, which move once, and those that may have a duplicate: rows whose
    columns that the fill does not touch have the same hash. ``keep`` writes what several steps read; without it no job is started.
    """
    spark = raw.sparkSession
    facts = facts or column_facts(raw, options.find_dates, SLICE_BY)
    nulls = facts.nulls(options.find_dates)
    key = SLICE_BY[0]
    bounds = ordered.sketched_bounds(spark, raw.schema[key].dataType, facts.sketches.get(key)) or ordered.slice_bounds(raw, SLICE_BY)
    df = cleaning.localize_dates(raw, options.zone, facts) if options.find_dates else raw
    df = cleaning.drop_sparse_columns(df, options.sparse_above, facts, options.find_dates).drop(*fixed.DROPPED_EARLY)
    have = set(df.columns)
    missing = [c for c in required_columns() if c not in have]
    if options.strict and missing:
        raise ValueError(f"columns absent or too sparse: {', '.join(missing)}")

    df = cleaning.impute_mode(df, [c for c in fixed.MODE_COLUMNS if c in have], lazily=keep is None)
    dates = [c for c in fixed.DATE_COLUMNS if c in have]
    as_time = {c: times.parse_wall_time(F.col(c)) for c in dates if isinstance(df.schema[c].dataType, T.StringType)}
    df = cleaning.without_zones(df.withColumns(as_time) if as_time else df)
    flags = [c for c in fixed.FLAG_COLUMNS if c in have]
    # a boolean with gaps is no criterion for duplicates
    gappy = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)
             and f.name not in fixed.MODE_COLUMNS and nulls.get(f.name)]
    df = cleaning.fill_zero(df, skip=[*flags, key])
    subset = cleaning.comparable_columns(df, exclude=gappy)

    to_fill = [c for c in dates if _has_gaps(raw, c, facts)]
    untouched = [c for c in subset if c not in to_fill and (c != key or not nulls[key])]
    known, marks = ordered.known_values(df, to_fill, key, bounds) if to_fill else None, repeated_marks(df, untouched)
    if keep:
        known, marks = known and keep(known, "known-values"), keep(marks, "repeated-marks")

    def filled(rows: DataFrame) -> DataFrame:
        rows = ordered.fill_forward(rows, to_fill, key, fixed.FILL_OFFSET_MS, bounds, known)
        return cleaning.fill_zero(cleaning.shift_timestamps(rows, dates, fixed.SHIFT_MS), skip=flags)

    unfilled, repeated = split_by_marks(df, untouched, marks)
    kept = cleaning.drop_duplicates_first(filled(repeated), subset, [F.col(key).asc_nulls_last()], [key])
    return _Parts(filled(unfilled), keep(kept, "kept-of-repeated") if keep else kept, unfilled)


def complete(raw: DataFrame, options: StageOptions, facts: ColumnFacts | None = None) -> DataFrame:
    """Dates parsed, sparse columns gone, nulls filled, duplicates dropped."""
    parts = _parts(raw, options, facts, None)
    return parts.single.unionByName(parts.kept)


def _types() -> dict[str, str]:
    return {
        **{c: "long" for c in fixed.LONG_COLUMNS},
        **{c: "double" for c in fixed.DOUBLE_COLUMNS},
        **{c: "boolean" for c in fixed.BOOLEAN_COLUMNS},
    }


def _with(df: DataFrame, name: str, needs: list[str], build) -> DataFrame:
    """Add a column when its inputs are present."""
    if any(c not in df.columns for c in needs):
        return df
    return df.withColumn(name, build(*[F.col(f"`{c}`") for c in needs]))


def enrich(df: DataFrame, options: StageOptions, votes: DataFrame | None = None) -> DataFrame:
    """Typed, renamed, with the derived columns. ``votes`` may hold the flags of all rows apart."""
    df = cleaning.cast_columns(df, _types())
    votes = votes and cleaning.cast_columns(votes, _types())
    df = cleaning.normalize_flag(df, [c for c in fixed.FLAG_COLUMNS if c in df.columns], options.legacy_zero, votes)
    df = _with(df, "tonelajevims", ["tonelajevims"], lambda t: numbers.rescale(t, 10))
    df = df.withColumnsRenamed(fixed.STAGE_NAMES)

    payload, loaded, empty = "tonelaje_segun_computadora", "porcentaje_combustible_camioncargando", "porcentaje_combustible_camiondescargando"
    tank = "capacidadtanque_equipoacarreo_galones"
    df = _with(df, "porcentaje_eficiencia_toneladas_movidas_acarreo", [payload, "tonelaje_nominal"], numbers.percentage)
    df = _with(df, "altura_elevacion", ["nivel_elevacion_descarga_metros", "nivel_elevacion_locacion_carga_metros"], numbers.distance)
    df = _with(df, "factor_perfil_rutavacio", ["efhvacio_mts", "distancia_recorrida_camionvacio_km_gps_mts"], numbers.ratio_or_zero)
    df = _with(df, "factor_perfil_rutacargado", ["efhcargado_mts", "distancia_recorrida_camioncargado_km_gps_mts"], numbers.ratio_or_zero)
    if "coord_x_pases" in df.columns:
        kind = text.type_of(df, "coord_x_pases")
        df = df.withColumn("numero_pases_carguio", text.element_count(F.col("coord_x_pases"), kind))
    else:
        df = df.withColumn("numero_pases_carguio", F.lit(0).cast("long"))
    full, drained = "Galones_disponibles_camioncargando", "Galones_disponibles_camiondescargando"
    df = _with(df, full, [loaded, tank], numbers.share_of)
    df = _with(df, drained, [empty, tank], numbers.share_of)
    return _with(df, "Galones_consumidos_entre_cargando_descargando_acarreo", [full, drained], lambda a, b: a - b)


def plausibility(df: DataFrame, options: StageOptions) -> tuple[DataFrame, dict[str, Column]]:
    """Enriched cycles with their pass tonnage, estimated passes, state and loading time, and the rules that plausible ones meet."""
    passes, capacity = "numero_pases_carguio", "capacidad_en_peso_equipo_carguio"
    payload, tonnes, state = "tonelaje_segun_computadora", "tonelaje_pases", "estado_primario_pala"
    start, end = "tiempo_inicio_carga_carguio", "tiempo_esperando_carguio"
    rules: dict[str, Column] = {}
    if start in df.columns:
        rules["first load"] = F.col(start) > F.lit(fixed.FIRST_LOAD).cast("timestamp_ntz")
    if options.min_passes is not None:
        rules["fewest passes"] = F.col(passes) >= options.min_passes
    if capacity in df.columns:
        rules["capacity"] = F.col(capacity) != 0
    if payload in df.columns:
        rules["payload"] = F.col(payload) > fixed.MIN_PAYLOAD
    if tonnes in df.columns:
        kind = text.type_of(df, tonnes)
        df = df.withColumn(tonnes, text.pass_tonnage(F.col(tonnes), kind, options.legacy_digits))
        rules["pass tonnage"] = (F.col(tonnes) > 0) & F.col(tonnes).between(*fixed.PASS_TONNAGE_BAND)
    df = _with(
        df, "numero_pases_carguio2", [payload, capacity, passes],
        lambda t, c, n: outliers.when_enough(numbers.round_half_even(F.try_divide(t, c)), n, fixed.MIN_PASSES),
    )
    if state in df.columns:
        df = df.withColumn(state, outliers.ready_state(F.col(state), F.col(passes)))
        rules["ready"] = F.col(state) == "READY"
    rules["passes"] = F.col(passes) > 0
    return _with(df, "tiempo_carga", [end, start], times.seconds_between), rules


def _finished(df: DataFrame) -> DataFrame:
    return cleaning.without_zones(df.drop(*fixed.DROPPED_LATE))


def stage_cycles(raw: DataFrame, options: StageOptions = StageOptions(), facts: ColumnFacts | None = None) -> DataFrame:
    """Raw cycles to stage cycles.

    ``raw`` should be a written table: it is scanned for the modes, for possible duplicates and for the rows, and for ``facts`` if
    they were not taken when it was written. Its wide rows are not written again: only narrow tables that several steps read, and
    rows that may have duplicates, go to the scratch folder. So rules and choices of columns reach the scan of ``raw``.
    """
    df, rules = plausibility(_enriched(raw, options, facts), options)
    for rule in rules.values():
        df = df.where(rule)
    return _finished(df)


def _enriched(raw: DataFrame, options: StageOptions, facts: ColumnFacts | None) -> DataFrame:
    parts = _parts(raw, options, facts, cut)
    df = parts.single.unionByName(parts.kept)
    flags = [c for c in fixed.FLAG_COLUMNS if c in df.columns]
    # filling times changes no flag
    votes = cut(parts.unfilled.select(*flags).unionByName(parts.kept.select(*flags)), "flags") if flags else None
    return enrich(df, options, votes)


def judged_stage(
    raw: DataFrame, options: StageOptions = StageOptions(), facts: ColumnFacts | None = None
) -> tuple[DataFrame, dict[str, Column]]:
    """All cycles as the stage has them, and the rules by which ``stage_cycles`` leaves some out.

    A rule may look at a column that the stage does not keep, so those stay until the rows are judged.
    """
    return plausibility(_enriched(raw, options, facts), options)
