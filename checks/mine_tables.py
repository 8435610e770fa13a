"""A mine derived from the supplied tables, so that the layers run on data that grows with them.

orders give the haul cycles and the shovel cycles, lineitem the sensor rows, events the state log,
region / nation / supplier the fleets, sub-fleets and machines, nation the places. ``mine_sql.py``
says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERIOD = ("2023-12-31 00:00:00", "2024-02-01 00:00:00")


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cycles(orders: DataFrame) -> DataFrame:
    k = "o_orderkey"
    base = f"timestampadd(SECOND, ({k} * 2311) % 2592000, TIMESTAMP_NTZ'2024-01-01 00:00:00')"
    loaded = f"timestampadd(SECOND, ({k} * 2311) % 2592000 + 120 + {k} % 60, TIMESTAMP_NTZ'2024-01-01 00:00:00')"

    def later(seconds: str, of: str = base) -> str:
        return f"timestampadd(SECOND, {seconds}, {of})"

    plain = orders.selectExpr(
        f"{k} AS id",
        f"{k} + 7 AS id_cargadescarga",
        f"CASE WHEN {k} % 40 = 39 THEN {k} + 1000000000 WHEN {k} % 40 = 38 THEN NULL ELSE {k} div 2 END AS id_palas",
        "1000 + o_custkey % 12 AS id_equipo",
        "1 + o_custkey % 25 AS id_descarga",
        f"{k} % 6 AS id_factor",
        "o_custkey AS id_trabajador",
        f"{k} + 1 AS id_palanext",
        f"{k} % 4 AS id_mezcla",
        f"{k} % 3 AS id_crewcarga",
        f"({k} + 1) % 3 AS id_crewdescarga",
        f"{k} % 3 AS id_turnocarga",
        f"({k} + 1) % 3 AS id_turnodescarga",
        f"{base} AS tiem_llegada",
        f"{later('30')} AS tiem_esperando",
        f"{later('60')} AS tiem_cuadra",
        f"{later('90')} AS tiem_cuadrado",
        f"{loaded} AS tiem_carga",
        f"{later('150 + o_custkey % 100', loaded)} AS tiem_acarreo",
        f"CASE WHEN {k} % 5 IN (2, 3) THEN NULL ELSE {later('900')} END AS tiem_cola",
        f"CASE WHEN {k} % 5 IN (2, 3) THEN NULL ELSE {later('960')} END AS tiem_retro",
        f"CASE WHEN {k} < 2 THEN NULL ELSE {later('990')} END AS tiem_listo",
        f"date_format({later('1020')}, 'yyyy-MM-dd HH:mm:ss') AS tiem_descarga",
        f"CASE WHEN {k} % 17 = 0 THEN NULL ELSE {later('1080')} END AS tiem_viajando",
        f"CASE WHEN {k} % 31 = 30 THEN {later('1')} END AS tiem_elimin",
        f"CASE WHEN {k} % 101 = 0 THEN 0 ELSE 200 + {k} % 50 END AS tonelaje",
        f"CAST(1400 + {k} % 1500 AS DOUBLE) AS tonelajevims",
        f"{k} % 2 = 0 AS yn_estado",
        "CAST(NULL AS BOOLEAN) AS yn_operador",
        "o_totalprice / 100 AS efhcargado",
        "o_totalprice / 200 AS efhvacio",
        f"CASE WHEN {k} % 13 = 0 THEN 0D ELSE {k} % 1000 + 0.5D END AS distrealcargado",
        f"CASE WHEN {k} % 19 = 0 THEN 0D ELSE {k} % 900 + 0.25D END AS distrealvacio",
        "o_totalprice AS coorxdesc",
        "o_totalprice + 1 AS coorydesc",
        "o_totalprice + 2 AS coorzdesc",
        f"CASE WHEN {k} % 6 = 0 THEN NULL ELSE CAST({k} % 3 AS DOUBLE) END AS tipodescargaidentifier",
        f"{k} % 11 AS tonelajevvanterior",
        f"CAST({k} % 7 AS DOUBLE) AS tonelajevvposterior",
        "CAST(NULL AS STRING) AS dumpreal",
        "CAST(NULL AS STRING) AS loadreal",
        f"20D + {k} % 10 AS velocidadvimscargado",
        f"30D + {k} % 10 AS velocidadvimsvacio",
        f"21D + {k} % 10 AS velocidadgpscargado",
        f"31D + {k} % 10 AS velocidadgpsvacio",
        f"CASE WHEN {k} % 10 = 0 THEN CAST({k} % 300 AS DOUBLE) END AS tonelajevimsretain",
        f"50D + {k} % 50 AS nivelcombuscargado",
        f"CASE WHEN {k} % 8 = 0 THEN NULL ELSE 40D + {k} % 50 END AS nivelcombusdescargado",
        f"100D + {k} % 9 AS volumen",
        f"{k} % 3 = 0 AS aplicafactor_vol",
        "o_totalprice / 7 AS coorzniveldescarga",
        f"{k} % 5 + 0.5D AS efh_factor_loaded",
        f"{k} % 4 + 0.5D AS efh_factor_empty",
    )
    # ids that repeat: once long before the period, once a second earlier inside it
    never = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
    old = plain.where("id % 10 = 3").withColumns({"tiem_llegada": never, "tiem_carga": never})
    earlier = plain.where("id % 10 = 4").withColumns({
        "tiem_llegada": F.expr("timestampadd(SECOND, -1, tiem_llegada)"),
        "tiem_carga": F.lit(None).cast("timestamp_ntz"),
        "tonelajevims": F.lit(0.0),
    })
    return plain.unionByName(old).unionByName(earlier)


def shovel_versions(orders: DataFrame) -> DataFrame:
    k = "o_orderkey"
    return orders.selectExpr(
        f"{k} AS id",
        f"{k} div 2 AS id_palas",
        f"1000 + {k} % 8 AS id_equipo",
        f"{k} % 25 AS id_locacion",
        f"CASE WHEN {k} % 9 = 1 THEN NULL ELSE o_custkey % 25 END AS id_poligono",
        "o_custkey AS id_trabajador",
        f"{k} % 3 AS id_crew",
        f"CASE WHEN {k} % 7 = 0 THEN NULL ELSE {k} % 3 = 0 END AS isspot",
        "CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' END AS bool_estado",
        f"{k} % 5 = 0 AS bool_equipo_next",
        f"CAST({k} % 6 AS DOUBLE) AS cola",
        f"CASE WHEN {k} % 46 = 45 THEN TIMESTAMP_NTZ'2024-01-15 00:00:00' END AS tiem_elimin",
    )


def sensor_rows(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "((l_orderkey * 1000000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber AS id",
        "l_orderkey div 2 AS id_palas",
        "l_orderkey + 7 AS id_cargadescarga",
        "encode(concat('{', substring_index('1,2,3,4,5,6,7,8', ',', l_linenumber + 1), '}'), 'UTF-8') AS coord_x",
        "encode(concat('{', l_linenumber, '}'), 'UTF-8') AS coord_y",
        "encode(concat('{', l_linenumber, '}'), 'UTF-8') AS coord_z",
        "encode(concat('{', l_partkey, '}'), 'UTF-8') AS angulo_giro",
        "concat('{', substring(repeat(concat(',', CAST(400 + 5 * l_quantity AS BIGINT)), l_linenumber + 1), 2), '}') AS tonelaje",
        "encode(concat('{', l_suppkey, '}'), 'UTF-8') AS duracion_excavacion",
        "l_extendedprice AS angulo_giro_promedio",
        "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_partkey % 2 = 0 END AS has_block",
        "CASE WHEN l_suppkey % 10 = 9 THEN l_shipdate END AS tiem_elimin",
    )


def state_log(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS id",
        "event_id * 10 AS id_estados",
        "1000 + user_id % 12 AS id_equipo",
        "CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3"
        " ELSE 4 END AS BIGINT) AS id_detal_estado",
        "ts AS tiempo_inicio",
        "CAST(value AS BIGINT) AS tiempo_estimado",
        "event_id % 2 AS idenestado",
        "CAST(NULL AS STRING) AS tipoubicacionsupervisor",
        "CASE WHEN event_id % 50 = 49 THEN ts END AS tiem_elimin",
    )


def state_types(region: DataFrame) -> DataFrame:
    leaf = region.selectExpr(
        "CAST(10 + r_regionkey AS BIGINT) AS id",
        "CAST(r_regionkey AS BIGINT) AS id_detal_estado",
        "CAST(20 + r_regionkey % 3 AS BIGINT) AS id_tipo_estad",
        "r_name AS nombre",
    )
    middle = region.selectExpr(
        "CAST(20 + r_regionkey AS BIGINT) AS id",
        "CAST(120 + r_regionkey AS BIGINT) AS id_detal_estado",
        "CAST(30 + r_regionkey % 2 AS BIGINT) AS id_tipo_estad",
        "concat('GROUP ', r_name) AS nombre",
    )
    root = region.selectExpr(
        "CAST(30 + r_regionkey AS BIGINT) AS id",
        "CAST(130 + r_regionkey AS BIGINT) AS id_detal_estado",
        "CAST(NULL AS BIGINT) AS id_tipo_estad",
        "CASE WHEN r_regionkey % 2 = 0 THEN 'READY' ELSE 'DELAY' END AS nombre",
    )
    return leaf.unionByName(middle).unionByName(root)


def machines(region: DataFrame, nation: DataFrame, supplier: DataFrame) -> DataFrame:
    fleets = region.selectExpr(
        "CAST(1 + r_regionkey AS BIGINT) AS id", "CAST(0 AS BIGINT) AS id_flota", "r_name AS nombre", "true AS isflota"
    )
    groups = nation.selectExpr(
        "CAST(100 + n_nationkey AS BIGINT) AS id",
        "CAST(1 + n_regionkey AS BIGINT) AS id_flota",
        "n_name AS nombre",
        "true AS isflota",
    )
    single = supplier.selectExpr(
        "1000 + s_suppkey AS id",
        "CAST(100 + s_nationkey AS BIGINT) AS id_flota",
        "s_name AS nombre",
        "false AS isflota",
        "20D + s_suppkey % 7 AS capacidad_vol",
        "CASE WHEN s_suppkey % 8 = 3 THEN 0D ELSE 60D + s_suppkey % 5 END AS capacidad_pes",
        "1000 + s_suppkey AS capacidadtanque",
        "1.5D AS fcorrec_efhod",
        "CAST(NULL AS DOUBLE) AS fcorrec_efhdo",
        "s_acctbal AS pesobruto",
        "s_suppkey % 2 = 0 AS ishp",
        "s_suppkey % 10 AS ancho",
        "s_suppkey % 20 AS largo",
        "4 + s_suppkey % 3 AS numeroejes",
        "CAST(s_suppkey % 4 AS STRING) AS tipoespecial",
        "s_acctbal / 10 AS radiohexagonoequipo",
        "s_suppkey % 6 AS radiohexagonocuchara",
        "CASE WHEN s_suppkey % 9 = 4 THEN TIMESTAMP_NTZ'2023-06-01 00:00:00' END AS tiem_elimin",
    )
    return single.unionByName(fleets, allowMissingColumns=True).unionByName(groups, allowMissingColumns=True)


def mine(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every table the raw layer reads, as expressions: a step reads of the supplied tables only what it needs, and nothing is copied."""
    return derived(spark, sf_dir)


def derived(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The mine's tables as expressions over the supplied ones."""
    region, nation = _load(spark, sf_dir, "region"), _load(spark, sf_dir, "nation")
    orders = _load(spark, sf_dir, "orders")
    n = "CAST(n_nationkey AS BIGINT)"
    return {
        "tp_cargadescarga": cycles(orders),
        "tp_palas": shovel_versions(orders),
        "tp_estados": state_log(_load(spark, sf_dir, "events")),
        "ts_detal_estado": state_types(region),
        "ta_datacarga_sensores": sensor_rows(_load(spark, sf_dir, "lineitem")),
        "ts_equipos": machines(region, nation, _load(spark, sf_dir, "supplier")),
        "ta_factortonelaje": region.selectExpr(
            "CAST(r_regionkey AS BIGINT) AS id",
            "CAST(1 + r_regionkey AS BIGINT) AS id_zona",
            "explode(array(NULL, CAST(CASE WHEN r_regionkey = 4 THEN NULL ELSE 700 + 10 * r_regionkey END AS BIGINT))) AS factor",
        ),
        "ts_turnos": region.selectExpr(
            "CAST(r_regionkey AS BIGINT) AS id",
            "CAST(1 + r_regionkey % 2 AS BIGINT) AS id_turnos",
            "r_name AS nombre",
            "CAST(r_regionkey * 6 AS BIGINT) AS horaini",
            "CAST(r_regionkey * 6 + 5 AS BIGINT) AS horafin",
            "CASE WHEN r_regionkey = 2 THEN TIMESTAMP_NTZ'2023-06-01 00:00:00' END AS tiem_elimin",
        ),
        "ts_descarga": nation.selectExpr(
            f"1 + {n} AS id",
            "CAST(n_regionkey AS BIGINT) AS id_tajo",
            f"{n} AS id_nodo",
            f"3000 + 10 * {n} AS nivel",
            "n_name AS nombre",
        ),
        "ts_locacion": nation.selectExpr(
            f"{n} AS id",
            f"24 - {n} AS id_nodo",
            "concat('LOC ', n_name) AS nombre",
            f"2900.5D + 7 * {n} AS nivel",
            f"50D + {n} AS radio",
            f"concat('{{', CAST({n} AS STRING), '}}') AS poligono_ids",
        ),
        "ts_poligono": nation.selectExpr(
            f"{n} AS id",
            "CAST(n_regionkey AS BIGINT) AS id_zona",
            f"{n} % 4 AS id_material",
            "concat('POL ', n_name) AS nombre",
            f"2800D + {n} AS nivel",
            f"2.5D + {n} / 100D AS densidad",
            f"10000D * ({n} + 1) AS tonelaje_inicial",
            "CAST(NULL AS STRING) AS ley_in",
        ),
        "tp_nodos": nation.selectExpr(
            f"{n} AS id",
            "CAST(n_regionkey AS BIGINT) AS idzona",
            "concat('NODE ', n_name) AS nombre_nodo",
            f"{n} % 2 = 0 AS loc_carga",
            f"{n} % 2 = 1 AS loc_descarga",
            f"CASE WHEN {n} = 6 THEN TIMESTAMP_NTZ'2023-06-01 00:00:00' END AS tiem_elimin",
        ),
    }
