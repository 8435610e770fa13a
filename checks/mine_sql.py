"""SQL for the derived mine and its layers, written apart from the Spark code."""

from __future__ import annotations

from loadcycle.plans import fixed_values as fixed

_BASE = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 2311) % 2592000))"
_LOADED = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 2311) % 2592000 + 120 + o_orderkey % 60))"


# n = l_linenumber + 1 passes, numbered and with the same tonnage each
_COUNTED = "('{' || array_to_string(range(1, l_linenumber + 2), ',') || '}')"
_TONNAGE = """('{' || array_to_string(list_transform(range(1, l_linenumber + 2),
    lambda i: CAST(trunc(400 + 5 * l_quantity) AS BIGINT)), ',') || '}')"""


MINE = f"""
plain_cycles AS (
  SELECT o_orderkey AS id, o_orderkey + 7 AS id_cargadescarga,
    CASE WHEN o_orderkey % 40 = 39 THEN o_orderkey + 1000000000 WHEN o_orderkey % 40 = 38 THEN NULL
         ELSE o_orderkey // 2 END AS id_palas,
    1000 + o_custkey % 12 AS id_equipo, 1 + o_custkey % 25 AS id_descarga, o_orderkey % 6 AS id_factor,
    o_custkey AS id_trabajador, o_orderkey + 1 AS id_palanext, o_orderkey % 4 AS id_mezcla,
    o_orderkey % 3 AS id_crewcarga, (o_orderkey + 1) % 3 AS id_crewdescarga,
    o_orderkey % 3 AS id_turnocarga, (o_orderkey + 1) % 3 AS id_turnodescarga,
    {_BASE} AS tiem_llegada, {_BASE} + to_seconds(30) AS tiem_esperando, {_BASE} + to_seconds(60) AS tiem_cuadra,
    {_BASE} + to_seconds(90) AS tiem_cuadrado, {_LOADED} AS tiem_carga,
    {_LOADED} + to_seconds(150 + o_custkey % 100) AS tiem_acarreo,
    CASE WHEN o_orderkey % 5 NOT IN (2, 3) THEN {_BASE} + to_seconds(900) END AS tiem_cola,
    CASE WHEN o_orderkey % 5 NOT IN (2, 3) THEN {_BASE} + to_seconds(960) END AS tiem_retro,
    CASE WHEN o_orderkey >= 2 THEN {_BASE} + to_seconds(990) END AS tiem_listo,
    strftime({_BASE} + to_seconds(1020), '%Y-%m-%d %H:%M:%S') AS tiem_descarga,
    CASE WHEN o_orderkey % 17 <> 0 THEN {_BASE} + to_seconds(1080) END AS tiem_viajando,
    CASE WHEN o_orderkey % 31 = 30 THEN {_BASE} + to_seconds(1) END AS tiem_elimin,
    CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE 200 + o_orderkey % 50 END AS tonelaje,
    CAST(1400 + o_orderkey % 1500 AS DOUBLE) AS tonelajevims, o_orderkey % 2 = 0 AS yn_estado,
    CAST(NULL AS BOOLEAN) AS yn_operador, o_totalprice / 100 AS efhcargado, o_totalprice / 200 AS efhvacio,
    CASE WHEN o_orderkey % 13 = 0 THEN 0e0 ELSE o_orderkey % 1000 + 0.5e0 END AS distrealcargado,
    CASE WHEN o_orderkey % 19 = 0 THEN 0e0 ELSE o_orderkey % 900 + 0.25e0 END AS distrealvacio,
    o_totalprice AS coorxdesc, o_totalprice + 1 AS coorydesc, o_totalprice + 2 AS coorzdesc,
    CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 3 AS DOUBLE) END AS tipodescargaidentifier,
    o_orderkey % 11 AS tonelajevvanterior, CAST(o_orderkey % 7 AS DOUBLE) AS tonelajevvposterior,
    CAST(NULL AS VARCHAR) AS dumpreal, CAST(NULL AS VARCHAR) AS loadreal,
    20e0 + o_orderkey % 10 AS velocidadvimscargado, 30e0 + o_orderkey % 10 AS velocidadvimsvacio,
    21e0 + o_orderkey % 10 AS velocidadgpscargado, 31e0 + o_orderkey % 10 AS velocidadgpsvacio,
    CASE WHEN o_orderkey % 10 = 0 THEN CAST(o_orderkey % 300 AS DOUBLE) END AS tonelajevimsretain,
    50e0 + o_orderkey % 50 AS nivelcombuscargado,
    CASE WHEN o_orderkey % 8 <> 0 THEN 40e0 + o_orderkey % 50 END AS nivelcombusdescargado,
    100e0 + o_orderkey % 9 AS volumen, o_orderkey % 3 = 0 AS aplicafactor_vol,
    o_totalprice / 7 AS coorzniveldescarga, o_orderkey % 5 + 0.5e0 AS efh_factor_loaded,
    o_orderkey % 4 + 0.5e0 AS efh_factor_empty
  FROM orders),
tp_cargadescarga AS (
  SELECT * FROM plain_cycles
  UNION ALL SELECT * REPLACE (TIMESTAMP '1990-01-01 00:00:00' AS tiem_llegada, TIMESTAMP '1990-01-01 00:00:00' AS tiem_carga)
    FROM plain_cycles WHERE id % 10 = 3
  UNION ALL SELECT * REPLACE (tiem_llegada - to_seconds(1) AS tiem_llegada, CAST(NULL AS TIMESTAMP) AS tiem_carga, 0e0 AS tonelajevims)
    FROM plain_cycles WHERE id % 10 = 4),
tp_palas AS (
  SELECT o_orderkey AS id, o_orderkey // 2 AS id_palas, 1000 + o_orderkey % 8 AS id_equipo,
    o_orderkey % 25 AS id_locacion, CASE WHEN o_orderkey % 9 <> 1 THEN o_custkey % 25 END AS id_poligono,
    o_custkey AS id_trabajador, o_orderkey % 3 AS id_crew,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 = 0 END AS isspot,
    CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' END AS bool_estado,
    o_orderkey % 5 = 0 AS bool_equipo_next, CAST(o_orderkey % 6 AS DOUBLE) AS cola,
    CASE WHEN o_orderkey % 46 = 45 THEN TIMESTAMP '2024-01-15 00:00:00' END AS tiem_elimin
  FROM orders),
ta_datacarga_sensores AS (
  SELECT ((l_orderkey * 1000000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber AS id,
    l_orderkey // 2 AS id_palas, l_orderkey + 7 AS id_cargadescarga,
    encode({_COUNTED}) AS coord_x, encode('{{' || l_linenumber || '}}') AS coord_y,
    encode('{{' || l_linenumber || '}}') AS coord_z, encode('{{' || l_partkey || '}}') AS angulo_giro,
    {_TONNAGE} AS tonelaje,
    encode('{{' || l_suppkey || '}}') AS duracion_excavacion, l_extendedprice AS angulo_giro_promedio,
    CASE WHEN l_partkey % 5 <> 0 THEN l_partkey % 2 = 0 END AS has_block,
    CASE WHEN l_suppkey % 10 = 9 THEN l_shipdate END AS tiem_elimin
  FROM lineitem),
tp_estados AS (
  SELECT event_id AS id, event_id * 10 AS id_estados, 1000 + user_id % 12 AS id_equipo,
    CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3
         ELSE 4 END AS BIGINT) AS id_detal_estado,
    ts AS tiempo_inicio, CAST(trunc(value) AS BIGINT) AS tiempo_estimado, event_id % 2 AS idenestado,
    CAST(NULL AS VARCHAR) AS tipoubicacionsupervisor, CASE WHEN event_id % 50 = 49 THEN ts END AS tiem_elimin
  FROM events),
ts_detal_estado AS (
  SELECT CAST(10 + r_regionkey AS BIGINT) AS id, CAST(r_regionkey AS BIGINT) AS id_detal_estado,
    CAST(20 + r_regionkey % 3 AS BIGINT) AS id_tipo_estad, r_name AS nombre FROM region
  UNION ALL SELECT 20 + r_regionkey, 120 + r_regionkey, 30 + r_regionkey % 2, 'GROUP ' || r_name FROM region
  UNION ALL SELECT 30 + r_regionkey, 130 + r_regionkey, NULL,
    CASE WHEN r_regionkey % 2 = 0 THEN 'READY' ELSE 'DELAY' END FROM region),
ts_equipos AS (
  SELECT 1000 + s_suppkey AS id, CAST(100 + s_nationkey AS BIGINT) AS id_flota, s_name AS nombre, false AS isflota,
    20e0 + s_suppkey % 7 AS capacidad_vol,
    CASE WHEN s_suppkey % 8 = 3 THEN 0e0 ELSE 60e0 + s_suppkey % 5 END AS capacidad_pes,
    1000 + s_suppkey AS capacidadtanque, 1.5e0 AS fcorrec_efhod, CAST(NULL AS DOUBLE) AS fcorrec_efhdo,
    s_acctbal AS pesobruto, s_suppkey % 2 = 0 AS ishp, s_suppkey % 10 AS ancho, s_suppkey % 20 AS largo,
    4 + s_suppkey % 3 AS numeroejes, CAST(s_suppkey % 4 AS VARCHAR) AS tipoespecial,
    s_acctbal / 10 AS radiohexagonoequipo, s_suppkey % 6 AS radiohexagonocuchara,
    CASE WHEN s_suppkey % 9 = 4 THEN TIMESTAMP '2023-06-01 00:00:00' END AS tiem_elimin
  FROM supplier
  UNION ALL BY NAME SELECT 1 + r_regionkey AS id, 0 AS id_flota, r_name AS nombre, true AS isflota FROM region
  UNION ALL BY NAME SELECT 100 + n_nationkey AS id, 1 + n_regionkey AS id_flota, n_name AS nombre, true AS isflota FROM nation),
ta_factortonelaje AS (
  SELECT r_regionkey AS id, CAST(1 + r_regionkey AS BIGINT) AS id_zona,
    CAST(CASE WHEN r_regionkey <> 4 THEN 700 + 10 * r_regionkey END AS BIGINT) AS factor FROM region
  UNION ALL SELECT r_regionkey, 1 + r_regionkey, NULL FROM region),
ts_turnos AS (
  SELECT r_regionkey AS id, CAST(1 + r_regionkey % 2 AS BIGINT) AS id_turnos, r_name AS nombre,
    CAST(r_regionkey * 6 AS BIGINT) AS horaini, CAST(r_regionkey * 6 + 5 AS BIGINT) AS horafin,
    CASE WHEN r_regionkey = 2 THEN TIMESTAMP '2023-06-01 00:00:00' END AS tiem_elimin FROM region),
ts_descarga AS (
  SELECT 1 + n_nationkey AS id, CAST(n_regionkey AS BIGINT) AS id_tajo, CAST(n_nationkey AS BIGINT) AS id_nodo,
    CAST(3000 + 10 * n_nationkey AS BIGINT) AS nivel, n_name AS nombre FROM nation),
ts_locacion AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(24 - n_nationkey AS BIGINT) AS id_nodo, 'LOC ' || n_name AS nombre,
    2900.5e0 + 7 * n_nationkey AS nivel, 50e0 + n_nationkey AS radio,
    '{{' || CAST(n_nationkey AS VARCHAR) || '}}' AS poligono_ids FROM nation),
ts_poligono AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS id_zona,
    CAST(n_nationkey % 4 AS BIGINT) AS id_material, 'POL ' || n_name AS nombre, 2800e0 + n_nationkey AS nivel,
    2.5e0 + n_nationkey / 100e0 AS densidad, 10000e0 * (n_nationkey + 1) AS tonelaje_inicial,
    CAST(NULL AS VARCHAR) AS ley_in FROM nation),
tp_nodos AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS idzona, 'NODE ' || n_name AS nombre_nodo,
    n_nationkey % 2 = 0 AS loc_carga, n_nationkey % 2 = 1 AS loc_descarga,
    CASE WHEN n_nationkey = 6 THEN TIMESTAMP '2023-06-01 00:00:00' END AS tiem_elimin FROM nation)
"""

_LOW, _HIGH = "TIMESTAMP '2023-12-31 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'"


def _ready(since: str, to: str) -> str:
    """READY seconds by pairing the span with every interval of its equipment (small data only).

    A span that ends before it starts holds no time.
    """
    return f"""
    CASE WHEN {to} <= {since} AND id_equipo_carguio IS NOT NULL THEN 0
      WHEN {since} IS NOT NULL AND {to} IS NOT NULL AND id_equipo_carguio IS NOT NULL THEN
      coalesce((SELECT sum(epoch_us(least(i.until, {to})) - epoch_us(greatest(i.since, {since}))) FROM ready_spans i
        WHERE i.id_equipo = c.id_equipo_carguio AND i.since < {to} AND i.until > {since}), 0) / 1e6 END"""


RAW = MINE + f""",
types AS (
  SELECT l.id_detal_estado, l.id_tipo_estad, l.nombre AS estado_detalle, m.nombre AS estado_secundario,
    r.nombre AS estado_primario
  FROM ts_detal_estado l LEFT JOIN ts_detal_estado m ON m.id = l.id_tipo_estad
  LEFT JOIN ts_detal_estado r ON r.id = m.id_tipo_estad),
spans AS (
  SELECT e.id_equipo, tiempo_inicio AS since, estado_primario,
    coalesce(lead(tiempo_inicio) OVER (PARTITION BY e.id_equipo ORDER BY tiempo_inicio, e.id), TIMESTAMP '2100-01-01') AS until
  FROM tp_estados e LEFT JOIN types USING (id_detal_estado) WHERE tiem_elimin IS NULL),
ready_spans AS (SELECT * FROM spans WHERE estado_primario = 'READY'),
states AS (
  SELECT e.id_estados, e.id_equipo, e.id_detal_estado, e.tiempo_inicio AS tiempo_inicio_cambio_estado,
    e.tiempo_estimado AS tiempo_estimado_duracion_estado, e.idenestado AS en_campo_o_taller_mantenimiento,
    e.tipoubicacionsupervisor, t.id_tipo_estad, t.estado_detalle, t.estado_secundario, t.estado_primario
  FROM (SELECT * FROM tp_estados WHERE tiem_elimin IS NULL
        QUALIFY row_number() OVER (PARTITION BY id_equipo ORDER BY tiempo_inicio DESC, id DESC) = 1) e
  LEFT JOIN types t USING (id_detal_estado)),
machines AS (
  SELECT c.*, g.id AS id_secundario, g.nombre AS secundario, r.id AS id_principal, r.nombre AS principal
  FROM ts_equipos c JOIN ts_equipos g ON g.id = c.id_flota AND g.tiem_elimin IS NULL
  JOIN ts_equipos r ON r.id = g.id_flota AND r.id_flota = 0 AND r.tiem_elimin IS NULL
  WHERE c.id_flota <> 0 AND NOT c.isflota AND c.tiem_elimin IS NULL),
newest AS (
  SELECT * FROM tp_palas QUALIFY row_number() OVER (PARTITION BY id_palas ORDER BY id DESC) = 1),
loads AS (
  SELECT c.id AS load_id, c.id_palas, p.id AS id_ciclo_carguio, p.id_equipo AS id_equipo_carguio, p.id_locacion,
    p.id_poligono, p.id_trabajador, p.id_crew, p.isspot, p.bool_estado, p.bool_equipo_next, p.cola,
    c.tiem_carga AS tiempo_inicio_carga_carguio, c.tiem_acarreo AS tiempo_esperando_carguio,
    lag(c.tiem_acarreo) OVER (PARTITION BY p.id_equipo ORDER BY c.tiem_carga, c.id) AS previous_esperando_pala
  FROM tp_cargadescarga c JOIN newest p ON p.id_palas = c.id_palas
  WHERE c.tiem_elimin IS NULL AND c.tiem_viajando IS NOT NULL AND p.tiem_elimin IS NULL
    AND c.tiem_carga > {_LOW} AND c.tiem_carga < {_HIGH}),
shovels AS (
  SELECT c.*, {_ready('c.tiempo_inicio_carga_carguio', 'c.tiempo_esperando_carguio')} AS tiempo_ready_cargando,
    {_ready('c.previous_esperando_pala', 'c.tiempo_inicio_carga_carguio')} AS tiempo_ready_esperando
  FROM (SELECT * FROM loads QUALIFY row_number() OVER (PARTITION BY id_palas ORDER BY load_id DESC) = 1) c),
sensors AS (
  SELECT * FROM ta_datacarga_sensores WHERE tiem_elimin IS NULL
  QUALIFY row_number() OVER (PARTITION BY id_cargadescarga ORDER BY id DESC) = 1),
raw AS (
  SELECT {', '.join(f'{source} AS {name}' for name, source in fixed.RAW_COLUMNS.items())},
    (cycle.tonelajevims / 10) * (factor.factor / 1000) AS toneladas_secas,
    (cycle.tonelajevims / 10) / nullif((shovel.tiempo_ready_cargando + shovel.tiempo_ready_esperando) / 3600, 0)
      AS productividad_operativa_carguio_tn_h,
    CAST(1 AS BIGINT) AS rownum
  FROM (SELECT * FROM tp_cargadescarga WHERE tiem_elimin IS NULL AND tiem_llegada > {_LOW} AND tiem_llegada < {_HIGH}
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY tiem_llegada DESC) = 1) cycle
  JOIN ta_factortonelaje factor ON factor.id = cycle.id_factor AND factor.factor IS NOT NULL
  LEFT JOIN machines truck ON truck.id = cycle.id_equipo
  LEFT JOIN ts_turnos load_shift ON load_shift.id = cycle.id_turnocarga AND load_shift.tiem_elimin IS NULL
  LEFT JOIN ts_turnos dump_shift ON dump_shift.id = cycle.id_turnodescarga AND dump_shift.tiem_elimin IS NULL
  LEFT JOIN ts_descarga dump ON dump.id = cycle.id_descarga
  LEFT JOIN tp_nodos dump_node ON dump_node.id = dump.id_nodo AND dump_node.loc_descarga AND dump_node.tiem_elimin IS NULL
  LEFT JOIN states truck_state ON truck_state.id_equipo = cycle.id_equipo
  LEFT JOIN shovels shovel ON shovel.id_palas = cycle.id_palas
  LEFT JOIN ts_locacion location ON location.id = shovel.id_locacion
  LEFT JOIN ts_poligono polygon ON polygon.id = shovel.id_poligono
  LEFT JOIN tp_nodos load_node ON load_node.id = location.id_nodo AND load_node.loc_carga AND load_node.tiem_elimin IS NULL
  LEFT JOIN machines digger ON digger.id = shovel.id_equipo_carguio
  LEFT JOIN states shovel_state ON shovel_state.id_equipo = shovel.id_equipo_carguio
  LEFT JOIN sensors passes ON passes.id_cargadescarga = cycle.id_cargadescarga)
"""

# Columns with more than 80 % nulls in the derived mine.
_SPARSE = """tipoubicacionsupervisor_camion tipoubicacionsupervisor_pala yn_operador dumpreal loadreal
tonelajevimsretain fcorrec_efhdo_equipo ley_in""".split()
# Types of the raw columns that no cast names.
_PLAIN = {
    "text": """nombre_equipo flota_secundaria flota_principal tipoespecial_equipo nombre_equipo_carguio nombre_turnocarga
        nombre_turnodescarga nombre_nodo_carga nombre_nodo_descarga nombre_descarga nombre_carga_locacion
        ids_poligonos_en_locacion nombre_poligono tonelaje_pases estado_detalle_camion estado_secundario_camion
        estado_primario_camion estado_detalle_pala estado_secundario_pala estado_primario_pala""".split(),
    "number": """id_mezcla fcorrec_efhod_equipo radiohexagonoequipo_equipo radiohexagonocuchara_equipo
        capacidadtanque_equipo_carguio radiohexagonoequipo_carguio id_zona_nodo_carga id_zona_nodo_descarga""".split(),
    "flag": ["tiene_camion_cuadrado_al_termino_carga_pala"],
    "bytes": "coord_x_pases coord_y_pases coord_z_pases angulo_giro_pases duracion_excavacion_pases".split(),
}


def _most_frequent(column: str) -> str:
    return f"(SELECT {column} FROM raw WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1)"


def _date(column: str, local_dates: bool) -> str:
    if column != "tiem_descarga":
        return column
    return f"CAST({column} AS TIMESTAMP)" + (" - INTERVAL 5 HOUR" if local_dates else "")


def _cleaned(local_dates: bool) -> str:
    done = []
    for c in [*fixed.RAW_COLUMNS, "toneladas_secas", "productividad_operativa_carguio_tn_h"]:
        if c in _SPARSE or c in fixed.DROPPED_EARLY:
            continue
        if c in fixed.DATE_COLUMNS:
            moment = _date(c, local_dates)
            last = f"last_value({moment} IGNORE NULLS) OVER (ORDER BY id_ciclo_acarreo ROWS UNBOUNDED PRECEDING)"
            done.append(f"coalesce({moment}, {last} + INTERVAL 3 SECOND) + INTERVAL 999 MILLISECOND AS {c}")
        elif c in fixed.MODE_COLUMNS:
            done.append(f"coalesce({c}, {_most_frequent(c)}) AS {c}")
        elif c in fixed.FLAG_COLUMNS:
            done.append(f"CAST(coalesce({c}, {_most_frequent(c)}) AS BOOLEAN) AS {c}")
        elif c in fixed.LONG_COLUMNS:
            done.append(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}")
        elif c in fixed.DOUBLE_COLUMNS:
            done.append(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}")
        elif c in fixed.BOOLEAN_COLUMNS or c in _PLAIN["flag"]:
            done.append(f"coalesce({c}, false) AS {c}")
        elif c in _PLAIN["text"]:
            done.append(f"coalesce({c}, '0') AS {c}")
        elif c in _PLAIN["number"]:
            done.append(f"coalesce({c}, 0) AS {c}")
        elif c in _PLAIN["bytes"]:
            done.append(c)
        else:
            raise KeyError(c)
    return ", ".join(done)


def _staged_columns() -> list[str]:
    names = []
    for c in [*fixed.RAW_COLUMNS, "toneladas_secas", "productividad_operativa_carguio_tn_h"]:
        name = fixed.STAGE_NAMES.get(c, c)
        if c in _SPARSE or c in fixed.DROPPED_EARLY or name in fixed.DROPPED_LATE:
            continue
        if c == "tonelajevims":
            names.append(f'tonelajevims / 10 AS "{name}"')
        elif c == "tonelaje_pases":
            names.append("tonnes AS tonelaje_pases")
        else:
            names.append(f'{c} AS "{name}"')
    return names


def stage(local_dates: bool = True, min_passes: int | None = None) -> str:
    """``WITH`` list that ends in ``stage``."""
    enough = "" if min_passes is None else f"AND passes >= {min_passes}"
    return RAW + f""",
cleaned AS (SELECT {_cleaned(local_dates)} FROM raw),
counted AS (
  SELECT *,
    CASE WHEN coord_x_pases IS NULL OR decode(coord_x_pases) = '{{}}' THEN 0
         ELSE len(string_split(decode(coord_x_pases), ',')) END AS passes,
    coalesce(list_sum(list_transform(regexp_extract_all(tonelaje_pases, '[0-9]+'), lambda x: CAST(x AS BIGINT))), 0) / 10 AS tonnes
  FROM cleaned),
stage AS (
  SELECT {', '.join(_staged_columns())},
    tonelajevims / 10 / nullif(tonelaje, 0) * 100 AS porcentaje_eficiencia_toneladas_movidas_acarreo,
    abs(elevacion_descarga - nivel_elevacion_locacion_mts) AS altura_elevacion,
    CASE WHEN distrealvacio <> 0 THEN efhvacio / distrealvacio ELSE 0 END AS factor_perfil_rutavacio,
    CASE WHEN distrealcargado <> 0 THEN efhcargado / distrealcargado ELSE 0 END AS factor_perfil_rutacargado,
    CAST(passes AS BIGINT) AS numero_pases_carguio,
    (nivelcombuscargado / 100) * capacidadtanque_equipo AS "Galones_disponibles_camioncargando",
    (nivelcombusdescargado / 100) * capacidadtanque_equipo AS "Galones_disponibles_camiondescargando",
    (nivelcombuscargado / 100) * capacidadtanque_equipo - (nivelcombusdescargado / 100) * capacidadtanque_equipo
      AS "Galones_consumidos_entre_cargando_descargando_acarreo",
    CASE WHEN passes >= 4 THEN round_even(tonelajevims / 10 / capacidad_pes_equipo_carguio, 0) END AS numero_pases_carguio2,
    (epoch_us(tiempo_esperando_carguio) - epoch_us(tiempo_inicio_carga_carguio)) / 1e6 AS tiempo_carga
  FROM counted
  WHERE tiempo_inicio_carga_carguio > TIMESTAMP '2023-01-01 00:00:00.999' AND capacidad_pes_equipo_carguio <> 0
    AND tonelajevims / 10 > 150 AND tonnes BETWEEN 180 AND 400 AND passes > 0 {enough})
"""


def mine_oracles() -> dict[str, str]:
    shown = ", ".join(f'"{c}"' for c in fixed.PRESENTATION_COLUMNS)
    kept = ", ".join(c for c in [*fixed.RAW_COLUMNS, "toneladas_secas", "productividad_operativa_carguio_tn_h", "rownum"]
                     if c not in _SPARSE)
    return {
        "raw_cycles": f"WITH {RAW} SELECT * FROM raw",
        "staged_cycles": f"WITH {stage()} SELECT * FROM stage",
        "staged_min_passes": f"WITH {stage(local_dates=False, min_passes=4)} SELECT * FROM stage",
        "staged_reduced": f"WITH {RAW} SELECT {kept} FROM raw",
        "presented_cycles": f"WITH {stage()} SELECT {shown} FROM stage",
        "quarantined_cycles": f"""WITH {stage()} SELECT id_ciclo_acarreo, CAST(passes AS BIGINT) AS numero_pases_carguio, tonnes AS tonelaje_pases,
            concat_ws(',', CASE WHEN NOT coalesce(tiempo_inicio_carga_carguio > TIMESTAMP '2023-01-01 00:00:00.999', false) THEN 'first load' END,
              CASE WHEN passes < 4 THEN 'fewest passes' END,
              CASE WHEN coalesce(capacidad_pes_equipo_carguio, 0) = 0 THEN 'capacity' END,
              CASE WHEN NOT coalesce(tonelajevims / 10 > 150, false) THEN 'payload' END,
              CASE WHEN NOT coalesce(tonnes BETWEEN 180 AND 400, false) THEN 'pass tonnage' END,
              CASE WHEN estado_primario_pala = 'DELAY' AND passes <= 0 THEN 'ready' END,
              CASE WHEN passes <= 0 THEN 'passes' END) AS broken FROM counted""",
        "daily_raw": f"WITH {RAW} SELECT * FROM raw".replace(_LOW, "TIMESTAMP '2023-12-31 23:59:59.999999'").replace(
            _HIGH, "TIMESTAMP '2024-01-04 00:00:00'"),
        "bucketed_passes": f"""WITH {MINE},
            p AS (SELECT id_cargadescarga, max(id) AS id FROM ta_datacarga_sensores WHERE tiem_elimin IS NULL GROUP BY 1),
            s AS (SELECT id_palas, max(id) AS id, arg_max(coalesce(tiem_elimin, TIMESTAMP '1900-01-01'), id) AS gone FROM tp_palas GROUP BY 1)
            SELECT c.id, c.tiem_llegada AS arrival, c.tonelajevims AS payload, p.id AS id_pases, s.id AS id_ciclo_carguio,
              nullif(gone, TIMESTAMP '1900-01-01') AS gone
            FROM tp_cargadescarga c LEFT JOIN p ON p.id_cargadescarga = c.id_cargadescarga LEFT JOIN s ON s.id_palas = c.id_palas""",
        "layered_run": f"WITH {stage()} SELECT {shown} FROM stage",
    }
