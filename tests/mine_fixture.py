"""A hand-made mine, small enough to work out every value on paper."""

import datetime as dt

from pyspark.sql import functions as F

DAY = dt.datetime(2023, 10, 2)
LOW, HIGH = "2023-10-01 00:00:00", "2023-10-05 00:00:00"

TIMES = "tiem_llegada tiem_esperando tiem_cuadra tiem_cuadrado tiem_carga tiem_acarreo tiem_cola tiem_retro tiem_listo tiem_descarga tiem_viajando".split()
NUMBERS = """efhcargado efhvacio distrealcargado distrealvacio coorxdesc coorydesc coorzdesc tipodescargaidentifier
tonelajevvposterior velocidadvimscargado velocidadvimsvacio velocidadgpscargado velocidadgpsvacio tonelajevimsretain
nivelcombuscargado nivelcombusdescargado volumen coorzniveldescarga efh_factor_loaded efh_factor_empty""".split()
KEYS = """id id_cargadescarga id_palas id_equipo id_descarga id_factor id_trabajador id_palanext id_mezcla id_crewcarga
id_crewdescarga id_turnocarga id_turnodescarga tonelaje tonelajevvanterior""".split()


def at(hours=0, minutes=0, seconds=0):
    return DAY + dt.timedelta(hours=hours, minutes=minutes, seconds=seconds)


def cycle(id, arrival, load, haul, **other):
    """A cycle that arrives, is loaded from ``load`` to ``haul`` and ends."""
    row = {k: 1 for k in KEYS} | {n: 10.0 for n in NUMBERS}
    row |= {"id": id, "id_cargadescarga": id, "id_palas": id, "id_equipo": 1000, "id_factor": 1, "id_descarga": 1}
    row |= {t: arrival for t in TIMES} | {"tiem_carga": load, "tiem_acarreo": haul, "tiem_viajando": haul, "tiem_elimin": None}
    row |= {"tonelaje": 200, "tonelajevims": 2500.0, "yn_estado": True, "yn_operador": None, "aplicafactor_vol": False,
            "dumpreal": None, "loadreal": None, "nivelcombuscargado": 80.0, "nivelcombusdescargado": 60.0}
    return row | other


def cycles():
    return [
        cycle(1, at(0), at(0, 10), at(0, 20)),
        cycle(2, at(1), at(1, 10), at(1, 30), id_palas=2),
        cycle(3, at(1), at(1, 10), at(1, 40), id_palas=3),  # starts loading with cycle 2
        cycle(4, at(2), at(2, 10), at(2, 20), id_palas=4),  # its newest shovel version is deleted
        cycle(5, at(3), at(3, 10), at(3, 20), id_palas=555),  # no shovel row
        cycle(6, at(4), at(4, 10), at(4, 20), id_factor=2),  # factor is null: out
        cycle(7, at(5), at(5, 10), at(5, 20), id_factor=9),  # no factor: out
        cycle(8, at(6), at(6, 10), at(6, 20), tiem_elimin=at(7)),  # deleted: out
        cycle(9, dt.datetime(2023, 10, 1), at(7, 10), at(7, 20), id_palas=9),  # on the lower bound: out
        cycle(10, dt.datetime(2023, 10, 5), at(8, 10), at(8, 20), id_palas=10),  # on the upper bound: out
        cycle(11, at(23), at(23, 30), at(24, 30), id_palas=11, id_equipo=1002),  # loads across midnight, deleted truck
        cycle(11, at(23), at(23, 30), at(24, 30), id_palas=11, id_equipo=1002),  # the same row once more
        cycle(12, at(30), at(30, 5), at(30, 9), id_palas=None),  # no shovel key
    ]


def tables(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    types = {t: "timestamp_ntz" for t in TIMES + ["tiem_elimin"]} | {n: "double" for n in NUMBERS + ["tonelajevims"]}
    types |= {b: "boolean" for b in ("yn_estado", "yn_operador", "aplicafactor_vol")} | {"dumpreal": "string", "loadreal": "string"}
    names = list(cycles()[0])
    schema = ", ".join(f"{n} {types.get(n, 'long')}" for n in names)
    shovel = [(i, i, 2000, 1, 1, 7, 1, True, "True", True, 2.0, None) for i in (1, 2, 3, 9, 10, 11)]
    shovel += [(40, 4, 2000, 1, 1, 7, 1, True, "True", True, 2.0, None), (41, 4, 2000, 1, 1, 7, 1, True, "True", True, 2.0, at(9))]
    shovel += [(100, 2, 2001, 2, 2, 8, 2, False, "False", False, 3.0, None)]  # a newer version of 2, on another machine
    states = [  # machine 2000: READY to 00:15, DELAY to 01:20, READY to 23:45, DELAY to 24:10, READY on
        (1, 2000, 0, at(-5), None), (2, 2000, 1, at(0, 15), None), (3, 2000, 0, at(1, 20), None),
        (4, 2000, 1, at(23, 45), None), (5, 2000, 0, at(24, 10), None), (6, 2000, 1, at(25), at(25)),  # the last one is deleted
        (7, 2001, 1, at(-5), None), (8, 1000, 0, at(1), None), (9, 1000, 1, at(1), None),
    ]
    sensors = [  # two rows for cycle 1, a deleted newest one for cycle 2
        (1, 1, 1, "{1,2,3}", "{600,600,600}", True, None), (2, 1, 1, "{1,2,3,4}", "{600,600,600,600}", False, None),
        (3, 2, 2, "{1,2}", "{900,900}", None, None), (4, 2, 2, "{9}", "{9}", None, at(1)),
        (5, 3, 3, "{}", "{}", None, None), (6, 11, 11, "{1,2,3,4,5}", "{500,500,500,500,500}", True, None),
    ]
    sensor = frame(sensors, "id long, id_palas long, id_cargadescarga long, x string, tonelaje string, has_block boolean, tiem_elimin timestamp_ntz")
    sensor = sensor.select(
        "id", "id_palas", "id_cargadescarga",
        *[F.encode("x", "UTF-8").alias(c) for c in "coord_x coord_y coord_z angulo_giro duracion_excavacion".split()],
        "tonelaje", F.lit(1.5).alias("angulo_giro_promedio"), "has_block", "tiem_elimin",
    )
    machine = "id long, id_flota long, nombre string, isflota boolean, capacidad_vol double, capacidad_pes double, tiem_elimin timestamp_ntz"
    machines = frame([
        (1, 0, "Trucks", True, None, None, None), (2, 0, "Shovels", True, None, None, None),
        (10, 1, "Truck group", True, None, None, None), (20, 2, "Shovel group", True, None, None, None),
        (1000, 10, "T-1000", False, 100.0, 220.0, None), (1002, 10, "T-1002", False, 100.0, 220.0, at(0)),
        (2000, 20, "S-2000", False, 30.0, 60.0, None), (2001, 20, "S-2001", False, 30.0, 0.0, None),
    ], machine)
    extra = {"capacidadtanque": F.lit(1000).cast("long"), "ishp": F.lit(True), "pesobruto": F.lit(1.0), "tipoespecial": F.lit("x")}
    extra |= {c: F.lit(1).cast("long") for c in "ancho largo numeroejes radiohexagonocuchara".split()}
    extra |= {c: F.lit(1.0) for c in "fcorrec_efhod fcorrec_efhdo radiohexagonoequipo".split()}
    return {
        "tp_cargadescarga": frame([tuple(c[n] for n in names) for c in cycles()], schema),
        "tp_palas": frame(shovel, """id long, id_palas long, id_equipo long, id_locacion long, id_poligono long, id_trabajador long,
            id_crew long, isspot boolean, bool_estado string, bool_equipo_next boolean, cola double, tiem_elimin timestamp_ntz"""),
        "tp_estados": frame([(i, i, e, d, t, 60, 1, None, x) for i, e, d, t, x in states], """id long, id_estados long, id_equipo long,
            id_detal_estado long, tiempo_inicio timestamp_ntz, tiempo_estimado long, idenestado long, tipoubicacionsupervisor string,
            tiem_elimin timestamp_ntz"""),
        "ts_detal_estado": frame([
            (1, 0, 3, "loading"), (2, 1, 4, "waiting"), (3, 93, 5, "working"), (4, 94, 6, "stopped"), (5, 95, None, "READY"), (6, 96, None, "DELAY"),
        ], "id long, id_detal_estado long, id_tipo_estad long, nombre string"),
        "ta_datacarga_sensores": sensor,
        "ts_equipos": machines.withColumns(extra),
        "ta_factortonelaje": frame([(1, 4, 900), (2, 4, None)], "id long, id_zona long, factor long"),
        "ts_turnos": frame([(1, 2, "Day", 6, 18, None), (1, 2, "Old", 0, 0, at(0))],
                           "id long, id_turnos long, nombre string, horaini long, horafin long, tiem_elimin timestamp_ntz"),
        "ts_descarga": frame([(1, 5, 2, 3000, "Dump")], "id long, id_tajo long, id_nodo long, nivel long, nombre string"),
        "ts_locacion": frame([(1, 1, "Face", 2900.0, 50.0, "{1}"), (2, 9, "Far", 2800.0, 50.0, "{2}")],
                             "id long, id_nodo long, nombre string, nivel double, radio double, poligono_ids string"),
        "ts_poligono": frame([(1, 3, 2, "P1", 2895.0, 2.6, 1e6, "0.5")],
                             "id long, id_zona long, id_material long, nombre string, nivel double, densidad double, tonelaje_inicial double, ley_in string"),
        "tp_nodos": frame([(1, 5, "N1", True, False, None), (2, 6, "N2", False, True, None)],
                          "id long, idzona long, nombre_nodo string, loc_carga boolean, loc_descarga boolean, tiem_elimin timestamp_ntz"),
    }
