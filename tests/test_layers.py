"""The layers end to end on a hand-made mine, against values worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadcycle.plans import fixed_values as fixed
from loadcycle.plans.presentation import presentation
from loadcycle.plans.raw import haul_cycles
from loadcycle.plans.stage import StageOptions, drop_sparse_only, stage_cycles
from loadcycle.sources.scratch import cut
from tests.mine_fixture import HIGH, LOW, at, tables


@pytest.fixture(scope="module")
def raw(spark):
    return cut(haul_cycles(tables(spark), LOW, HIGH), "hand-made")


@pytest.fixture(scope="module")
def row(raw):
    return {r.id_ciclo_acarreo: r for r in raw.collect()}


def test_which_cycles_stay(raw, row):
    assert sorted(row) == [1, 2, 3, 4, 5, 11, 12] and raw.count() == 7


def test_raw_columns(raw):
    assert raw.columns == [*fixed.RAW_COLUMNS, "toneladas_secas", "productividad_operativa_carguio_tn_h", "rownum"]
    assert len(fixed.RAW_COLUMNS) == 153


def test_newest_shovel_version_wins_and_a_deleted_one_leaves_nothing(row):
    assert (row[2].id_ciclo_carguio, row[2].id_equipo_carguio) == (100, 2001)
    assert row[4].id_ciclo_carguio is None and row[5].id_ciclo_carguio is None and row[12].id_ciclo_carguio is None


def test_ready_time_and_previous_load(row):
    # cycle 1 loads 00:10-00:20 and the machine is READY until 00:15
    assert row[1].tiempo_ready_cargando_pala == 300.0
    assert row[1].previous_esperando_pala is None and row[1].tiempo_ready_esperando_pala is None
    # cycle 3 loads 01:10-01:40, READY from 01:20; it waited since 00:20, all of it in DELAY
    assert row[3].previous_esperando_pala == at(0, 20)
    assert (row[3].tiempo_ready_cargando_pala, row[3].tiempo_ready_esperando_pala) == (1200.0, 0.0)
    # cycle 11 loads across midnight: READY 23:30-23:45 and 24:10-24:30; the deleted state does not count
    assert row[11].tiempo_ready_cargando_pala == 35 * 60.0
    # machine 2001 was never READY: no rate
    assert row[2].tiempo_ready_cargando_pala == 0.0 and row[2].productividad_operativa_carguio_tn_h is None


def test_computed_columns(row):
    assert row[1].toneladas_secas == pytest.approx(250 * 0.9)
    assert row[1].productividad_operativa_carguio_tn_h is None
    assert row[3].productividad_operativa_carguio_tn_h == pytest.approx(250 / (1200 / 3600))


def test_dimensions(row):
    assert (row[1].nombre_equipo, row[1].flota_secundaria, row[1].flota_principal) == ("T-1000", "Truck group", "Trucks")
    assert row[11].nombre_equipo is None  # the truck is deleted
    assert (row[1].estado_detalle_camion, row[1].estado_secundario_camion, row[1].estado_primario_camion) == ("waiting", "stopped", "DELAY")
    assert row[1].estado_primario_pala == "READY" and row[1].nombre_turnocarga == "Day"
    assert (row[1].nombre_nodo_carga, row[1].nombre_nodo_descarga) == ("N1", "N2")
    assert row[2].nombre_nodo_carga is None and row[2].nombre_carga_locacion == "Far" and row[2].id_material is None


def test_newest_sensor_row_that_is_alive(row):
    assert (row[1].id_pases, row[1].tonelaje_pases) == (2, "{600,600,600,600}")
    assert row[2].id_pases == 3 and row[4].id_pases is None


def test_integer_division_and_key_option(spark):
    whole = haul_cycles(tables(spark), LOW, HIGH, integer_division=True)
    assert {r.toneladas_secas for r in whole.collect()} == {0}
    assert haul_cycles(tables(spark), LOW, HIGH, cycle_id_is_key=True).count() == 8  # the repeated row stays


def test_stage_by_hand(raw):
    stage = {r.id_ciclo_acarreo: r.asDict() for r in stage_cycles(raw).collect()}
    # 2: machine without capacity; 3: no passes; 4, 5, 12: no machine, hence no capacity
    assert sorted(stage) == [1, 11]
    one = stage[1]
    assert (one["numero_pases_carguio"], one["tonelaje_pases"], one["numero_pases_carguio2"]) == (4, 240.0, 4.0)
    assert one["tonelaje_segun_computadora"] == 250.0
    assert one["porcentaje_eficiencia_toneladas_movidas_acarreo"] == 125.0
    assert one["altura_elevacion"] == 100.0 and one["tiempo_carga"] == 600.0
    assert one["factor_perfil_rutacargado"] == 1.0
    assert one["Galones_consumidos_entre_cargando_descargando_acarreo"] == pytest.approx(200.0)
    assert one["tiempo_inicio_carga_carguio"] == at(0, 10) + dt.timedelta(milliseconds=999)
    assert "previous_esperando_pala" not in one and "coord_x_pases" not in one and "dumpreal" not in one


def test_stage_columns_and_types(raw):
    stage = stage_cycles(raw)
    assert "tonelaje_nominal" in stage.columns and "tonelaje" not in stage.columns
    types = dict(stage.dtypes)
    assert types["al_termino_cargar_en_espera_cuadrado_cuadrandose"] == "boolean"
    assert types["cambio_estado_operatividad_carguio"] == "boolean"
    assert types["id_ciclo_carguio"] == "double" and types["id_palas"] == "bigint"
    assert "timestamp" not in types.values()


def test_stage_drops_repeated_rows_and_ignores_input_order(raw):
    once = sorted(stage_cycles(raw).collect(), key=str)
    doubled = raw.unionByName(raw).repartition(5)
    assert sorted(stage_cycles(cut(doubled, "doubled")).collect(), key=str) == once


def test_minimum_passes(raw):
    few = raw.withColumn("coord_x_pases", F.encode(F.lit("{1,2,3}"), "UTF-8"))
    few = cut(few, "few")
    assert stage_cycles(few, StageOptions(min_passes=4)).count() == 0
    kept = stage_cycles(few).collect()
    assert kept and {r.numero_pases_carguio2 for r in kept} == {None}


def test_arrays_instead_of_bytes(raw):
    arrays = raw.withColumns({
        "coord_x_pases": F.split(F.btrim(F.decode("coord_x_pases", "UTF-8"), F.lit("{}")), ",").try_cast("array<double>"),
        "tonelaje_pases": F.split(F.btrim("tonelaje_pases", F.lit("{}")), ",").try_cast("array<double>"),
    })
    got = {r.id_ciclo_acarreo: r for r in stage_cycles(cut(arrays, "arrays")).collect()}
    assert (got[1].numero_pases_carguio, got[1].tonelaje_pases) == (4, 240.0)


def test_absent_columns(raw):
    without = raw.drop("has_block_pases", "volumen", "nivelcombuscargado")
    got = stage_cycles(cut(without, "without"))
    assert "volumen_nominal" not in got.columns and got.count() == 2
    with pytest.raises(ValueError, match="has_block_pases"):
        stage_cycles(without, StageOptions(strict=True))


def test_reduced_stage_only_drops_sparse_columns(raw):
    got = drop_sparse_only(raw)
    assert "dumpreal" not in got.columns and got.count() == raw.count() and "rownum" in got.columns


def test_presentation(raw):
    got = presentation(stage_cycles(raw))
    assert got.columns == fixed.PRESENTATION_COLUMNS and len(got.columns) == 17
    assert {r.id_ciclo_acarreo for r in got.collect()} == {1, 11}


def test_repeated_ids_outside_the_period_take_nothing_away(spark):
    mine = tables(spark)
    old = mine["tp_cargadescarga"].withColumn("tiem_llegada", F.lit("1990-05-05 00:00:00").cast("timestamp_ntz"))
    gaps = mine["ta_factortonelaje"].withColumn("factor", F.lit(None).cast("long"))
    mine["tp_cargadescarga"] = mine["tp_cargadescarga"].unionByName(old.withColumn("tiem_carga", F.col("tiem_llegada")))
    mine["ta_factortonelaje"] = mine["ta_factortonelaje"].unionByName(gaps)
    assert sorted(r.id_ciclo_acarreo for r in haul_cycles(mine, LOW, HIGH).collect()) == [1, 2, 3, 4, 5, 11, 12]


def test_a_state_that_began_long_before_the_span_counts(spark):
    from loadcycle.plans.raw import states_that_count
    log = spark.createDataFrame(
        [(1, 9, 5, at(0, 0) - dt.timedelta(days=900), None), (2, 9, 6, at(0, 0) - dt.timedelta(days=800), None),
         (3, 9, 5, at(1, 0), None), (4, 9, 6, at(3, 0), None)],
        "id long, id_equipo long, id_detal_estado long, tiempo_inicio timestamp_ntz, tiem_elimin timestamp_ntz",
    )
    got = states_that_count({"tp_estados": log}, F.lit(at(0, 30)), F.lit(at(2, 0)))
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_fixed_values_hold_a_few_pairs_literally():
    assert fixed.RAW_COLUMNS["id_ciclo_acarreo"] == "cycle.id"
    assert fixed.RAW_COLUMNS["id_equipo_carguio"] == "shovel.id_equipo_carguio"
    assert fixed.STAGE_NAMES["tonelajevims"] == "tonelaje_segun_computadora"
    assert fixed.STAGE_NAMES["efhvacio"] == "efhvacio_mts"
    assert (fixed.COLUMN_TYPES["id_palas"], fixed.COLUMN_TYPES["id_ciclo_carguio"], fixed.COLUMN_TYPES["yn_estado"]) == ("long", "double", "boolean")
