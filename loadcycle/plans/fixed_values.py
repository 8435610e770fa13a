"""Table and column names, types, thresholds and formats that the results must carry.

They are data: dict and list literals, columns in the order of the raw row.
"""

from __future__ import annotations


# Zone of the mine's wall clock.
ZONE = "America/Lima"

# Tables the raw layer reads.
TABLES = [
    "tp_cargadescarga",
    "tp_palas",
    "tp_estados",
    "ts_detal_estado",
    "ta_datacarga_sensores",
    "ts_equipos",
    "ta_factortonelaje",
    "ts_turnos",
    "ts_descarga",
    "ts_locacion",
    "ts_poligono",
    "tp_nodos",
]

# Raw column -> where it comes from. "rownum" and the computed columns are added in code.
RAW_COLUMNS = {
    "id_ciclo_acarreo": "cycle.id",
    "id_cargadescarga": "cycle.id_cargadescarga",
    "id_palas": "cycle.id_palas",
    "id_equipo_camion": "cycle.id_equipo",
    "id_ciclo_carguio": "shovel.id_ciclo_carguio",
    "id_equipo_carguio": "shovel.id_equipo_carguio",
    "id_trabajador_pala": "shovel.id_trabajador",
    "id_guardia_realiza_carga_al_camion": "shovel.id_crew",
    "id_locacion": "shovel.id_locacion",
    "id_poligono_se_obtiene_material": "shovel.id_poligono",
    "tiempo_inicio_carga_carguio": "shovel.tiempo_inicio_carga_carguio",
    "tiempo_esperando_carguio": "shovel.tiempo_esperando_carguio",
    "tiempo_ready_cargando_pala": "shovel.tiempo_ready_cargando",
    "tiempo_ready_esperando_pala": "shovel.tiempo_ready_esperando",
    "previous_esperando_pala": "shovel.previous_esperando_pala",
    "termino_carga_equipo_en_espera_cuadrado_cuadrandose_carguio": "shovel.isspot",
    "cambio_estado_operatividad_carguio": "shovel.bool_estado",
    "tiene_camion_cuadrado_al_termino_carga_pala": "shovel.bool_equipo_next",
    "cantidad_equipos_espera_al_termino_carga_pala": "shovel.cola",
    "id_estados_camion": "truck_state.id_estados",
    "id_equipo_table_estados_camion": "truck_state.id_equipo",
    "id_detal_estado_camion": "truck_state.id_detal_estado",
    "tiempo_inicio_cambio_estado_camion": "truck_state.tiempo_inicio_cambio_estado",
    "tiempo_estimado_duracion_estado_camion": "truck_state.tiempo_estimado_duracion_estado",
    "en_campo_o_taller_mantenimiento_camion": "truck_state.en_campo_o_taller_mantenimiento",
    "tipoubicacionsupervisor_camion": "truck_state.tipoubicacionsupervisor",
    "id_tipo_estad_camion": "truck_state.id_tipo_estad",
    "estado_detalle_camion": "truck_state.estado_detalle",
    "estado_secundario_camion": "truck_state.estado_secundario",
    "estado_primario_camion": "truck_state.estado_primario",
    "id_estados_pala": "shovel_state.id_estados",
    "id_equipo_table_estados_pala": "shovel_state.id_equipo",
    "id_detal_estado_pala": "shovel_state.id_detal_estado",
    "tiempo_inicio_cambio_estado_pala": "shovel_state.tiempo_inicio_cambio_estado",
    "tiempo_estimado_duracion_estado_pala": "shovel_state.tiempo_estimado_duracion_estado",
    "en_campo_o_taller_mantenimiento_pala": "shovel_state.en_campo_o_taller_mantenimiento",
    "tipoubicacionsupervisor_pala": "shovel_state.tipoubicacionsupervisor",
    "id_tipo_estad_pala": "shovel_state.id_tipo_estad",
    "estado_detalle_pala": "shovel_state.estado_detalle",
    "estado_secundario_pala": "shovel_state.estado_secundario",
    "estado_primario_pala": "shovel_state.estado_primario",
    "id_descarga": "cycle.id_descarga",
    "id_factor": "cycle.id_factor",
    "id_poligono": "shovel.id_poligono",
    "tiem_llegada_global": "cycle.tiem_llegada",
    "tiem_esperando": "cycle.tiem_esperando",
    "tiem_cuadra": "cycle.tiem_cuadra",
    "tiem_cuadrado": "cycle.tiem_cuadrado",
    "tiem_carga": "cycle.tiem_carga",
    "tiem_acarreo": "cycle.tiem_acarreo",
    "tiem_cola": "cycle.tiem_cola",
    "tiem_retro": "cycle.tiem_retro",
    "tiem_listo": "cycle.tiem_listo",
    "tiem_descarga": "cycle.tiem_descarga",
    "tiem_viajando": "cycle.tiem_viajando",
    "id_trabajador_camion": "cycle.id_trabajador",
    "id_palanext": "cycle.id_palanext",
    "tonelaje": "cycle.tonelaje",
    "tonelajevims": "cycle.tonelajevims",
    "id_mezcla": "cycle.id_mezcla",
    "yn_estado": "cycle.yn_estado",
    "yn_operador": "cycle.yn_operador",
    "id_guardia_hizocarga": "cycle.id_crewcarga",
    "id_guardia_hizodescarga": "cycle.id_crewdescarga",
    "id_zona_aplicafactor": "factor.id_zona",
    "id_zona_pertenece_poligono": "polygon.id_zona",
    "factor": "factor.factor",
    "efhcargado": "cycle.efhcargado",
    "efhvacio": "cycle.efhvacio",
    "distrealcargado": "cycle.distrealcargado",
    "distrealvacio": "cycle.distrealvacio",
    "coorxdesc": "cycle.coorxdesc",
    "coorydesc": "cycle.coorydesc",
    "coorzdesc": "cycle.coorzdesc",
    "tipodescargaidentifier": "cycle.tipodescargaidentifier",
    "tonelajevvanterior": "cycle.tonelajevvanterior",
    "tonelajevvposterior": "cycle.tonelajevvposterior",
    "dumpreal": "cycle.dumpreal",
    "loadreal": "cycle.loadreal",
    "velocidadvimscargado": "cycle.velocidadvimscargado",
    "velocidadvimsvacio": "cycle.velocidadvimsvacio",
    "velocidadgpscargado": "cycle.velocidadgpscargado",
    "velocidadgpsvacio": "cycle.velocidadgpsvacio",
    "tonelajevimsretain": "cycle.tonelajevimsretain",
    "nivelcombuscargado": "cycle.nivelcombuscargado",
    "nivelcombusdescargado": "cycle.nivelcombusdescargado",
    "volumen": "cycle.volumen",
    "aplicafactor_vol": "cycle.aplicafactor_vol",
    "coorzniveldescarga": "cycle.coorzniveldescarga",
    "efh_factor_loaded": "cycle.efh_factor_loaded",
    "efh_factor_empty": "cycle.efh_factor_empty",
    "nombre_equipo": "truck.nombre",
    "id_secundario": "truck.id_secundario",
    "flota_secundaria": "truck.secundario",
    "id_principal": "truck.id_principal",
    "flota_principal": "truck.principal",
    "capacidad_vol_equipo": "truck.capacidad_vol",
    "capacidad_pes_equipo": "truck.capacidad_pes",
    "capacidadtanque_equipo": "truck.capacidadtanque",
    "fcorrec_efhod_equipo": "truck.fcorrec_efhod",
    "fcorrec_efhdo_equipo": "truck.fcorrec_efhdo",
    "peso_bruto_equipo": "truck.pesobruto",
    "ishp_equipo": "truck.ishp",
    "ancho_equipo": "truck.ancho",
    "largo_equipo": "truck.largo",
    "numeroejes_equipo": "truck.numeroejes",
    "tipoespecial_equipo": "truck.tipoespecial",
    "radiohexagonoequipo_equipo": "truck.radiohexagonoequipo",
    "radiohexagonocuchara_equipo": "truck.radiohexagonocuchara",
    "nombre_equipo_carguio": "digger.nombre",
    "capacidad_vol_equipo_carguio": "digger.capacidad_vol",
    "capacidad_pes_equipo_carguio": "digger.capacidad_pes",
    "capacidadtanque_equipo_carguio": "digger.capacidadtanque",
    "radiohexagonoequipo_carguio": "digger.radiohexagonoequipo",
    "radiohexagonocuchara_equipo_carguio": "digger.radiohexagonocuchara",
    "id_turnos_turnocarga": "load_shift.id_turnos",
    "nombre_turnocarga": "load_shift.nombre",
    "horaini_turnocarga": "load_shift.horaini",
    "horafin_turnocarga": "load_shift.horafin",
    "id_turnos_turnodescarga": "dump_shift.id_turnos",
    "nombre_turnodescarga": "dump_shift.nombre",
    "horaini_turnodescarga": "dump_shift.horaini",
    "horafin_turnodescarga": "dump_shift.horafin",
    "id_zona_encuentra_descarga": "dump.id_tajo",
    "id_nodo_carga": "location.id_nodo",
    "nombre_nodo_carga": "load_node.nombre_nodo",
    "id_zona_nodo_carga": "load_node.idzona",
    "id_nodo_descarga": "dump.id_nodo",
    "nombre_nodo_descarga": "dump_node.nombre_nodo",
    "id_zona_nodo_descarga": "dump_node.idzona",
    "elevacion_descarga": "dump.nivel",
    "nombre_descarga": "dump.nombre",
    "nombre_carga_locacion": "location.nombre",
    "nivel_elevacion_locacion_mts": "location.nivel",
    "radio_locacion": "location.radio",
    "ids_poligonos_en_locacion": "location.poligono_ids",
    "id_material": "polygon.id_material",
    "nombre_poligono": "polygon.nombre",
    "elevacion_poligono_mts": "polygon.nivel",
    "ley_in": "polygon.ley_in",
    "densidad_poligono": "polygon.densidad",
    "tonelaje_inicial_poligono": "polygon.tonelaje_inicial",
    "id_pases": "passes.id",
    "id_palas_pases": "passes.id_palas",
    "id_cargadescarga_pases": "passes.id_cargadescarga",
    "coord_x_pases": "passes.coord_x",
    "coord_y_pases": "passes.coord_y",
    "coord_z_pases": "passes.coord_z",
    "angulo_giro_pases": "passes.angulo_giro",
    "tonelaje_pases": "passes.tonelaje",
    "duracion_excavacion_pases": "passes.duracion_excavacion",
    "angulo_giro_promedio_pases": "passes.angulo_giro_promedio",
    "has_block_pases": "passes.has_block",
}

# Raw columns of no use to the stage layer.
DROPPED_EARLY = [
    "tipoubicacionsupervisor_camion",
    "tipoubicacionsupervisor_pala",
    "id_cargadescarga_pases",
    "dumpreal",
    "loadreal",
    "rownum",
]

# Columns whose nulls become the most frequent value.
MODE_COLUMNS = [
    "has_block_pases",
    "tipodescargaidentifier",
]

# Time columns of the raw layer.
DATE_COLUMNS = [
    "tiem_llegada_global",
    "tiem_esperando",
    "tiem_cuadra",
    "tiem_cuadrado",
    "tiem_carga",
    "tiem_acarreo",
    "tiem_cola",
    "tiem_retro",
    "tiem_listo",
    "tiem_descarga",
    "tiem_viajando",
    "tiempo_inicio_carga_carguio",
    "tiempo_esperando_carguio",
    "previous_esperando_pala",
    "tiempo_inicio_cambio_estado_camion",
    "tiempo_inicio_cambio_estado_pala",
]

# Offset of a filled date, and the shift of every date, in milliseconds.
FILL_OFFSET_MS = 3000
SHIFT_MS = 999

# Types of the stage layer.
COLUMN_TYPES = {
    "id_ciclo_acarreo": "long",
    "id_cargadescarga": "long",
    "id_palas": "long",
    "id_equipo_camion": "long",
    "id_ciclo_carguio": "double",
    "id_equipo_carguio": "double",
    "id_trabajador_pala": "double",
    "id_guardia_realiza_carga_al_camion": "double",
    "id_locacion": "double",
    "id_poligono_se_obtiene_material": "double",
    "tiempo_ready_cargando_pala": "double",
    "tiempo_ready_esperando_pala": "double",
    "cantidad_equipos_espera_al_termino_carga_pala": "double",
    "id_estados_camion": "long",
    "id_equipo_table_estados_camion": "long",
    "id_detal_estado_camion": "long",
    "tiempo_estimado_duracion_estado_camion": "long",
    "en_campo_o_taller_mantenimiento_camion": "long",
    "id_tipo_estad_camion": "long",
    "id_estados_pala": "double",
    "id_equipo_table_estados_pala": "double",
    "id_detal_estado_pala": "double",
    "tiempo_estimado_duracion_estado_pala": "double",
    "en_campo_o_taller_mantenimiento_pala": "double",
    "id_tipo_estad_pala": "double",
    "id_descarga": "long",
    "id_factor": "long",
    "id_poligono": "double",
    "id_trabajador_camion": "long",
    "id_palanext": "long",
    "tonelaje": "long",
    "tonelajevims": "double",
    "yn_estado": "boolean",
    "id_guardia_hizocarga": "long",
    "id_guardia_hizodescarga": "long",
    "id_zona_aplicafactor": "long",
    "id_zona_pertenece_poligono": "double",
    "factor": "long",
    "efhcargado": "double",
    "efhvacio": "double",
    "distrealcargado": "double",
    "distrealvacio": "double",
    "coorxdesc": "double",
    "coorydesc": "double",
    "coorzdesc": "double",
    "tipodescargaidentifier": "double",
    "tonelajevvanterior": "long",
    "tonelajevvposterior": "double",
    "velocidadvimscargado": "double",
    "velocidadvimsvacio": "double",
    "velocidadgpscargado": "double",
    "velocidadgpsvacio": "double",
    "tonelajevimsretain": "double",
    "nivelcombuscargado": "double",
    "nivelcombusdescargado": "double",
    "volumen": "double",
    "aplicafactor_vol": "boolean",
    "coorzniveldescarga": "double",
    "efh_factor_loaded": "double",
    "efh_factor_empty": "double",
    "id_secundario": "long",
    "id_principal": "long",
    "capacidad_vol_equipo": "double",
    "capacidad_pes_equipo": "double",
    "capacidadtanque_equipo": "long",
    "peso_bruto_equipo": "double",
    "ishp_equipo": "boolean",
    "ancho_equipo": "long",
    "largo_equipo": "long",
    "numeroejes_equipo": "long",
    "capacidad_vol_equipo_carguio": "double",
    "capacidad_pes_equipo_carguio": "double",
    "radiohexagonocuchara_equipo_carguio": "long",
    "id_turnos_turnocarga": "long",
    "horaini_turnocarga": "long",
    "horafin_turnocarga": "long",
    "id_turnos_turnodescarga": "long",
    "horaini_turnodescarga": "long",
    "horafin_turnodescarga": "long",
    "id_zona_encuentra_descarga": "long",
    "id_nodo_carga": "double",
    "id_nodo_descarga": "long",
    "elevacion_descarga": "long",
    "nivel_elevacion_locacion_mts": "double",
    "radio_locacion": "double",
    "id_material": "double",
    "elevacion_poligono_mts": "double",
    "densidad_poligono": "double",
    "tonelaje_inicial_poligono": "double",
    "id_pases": "double",
    "id_palas_pases": "double",
    "angulo_giro_promedio_pases": "double",
    "has_block_pases": "boolean",
    "toneladas_secas": "double",
    "productividad_operativa_carguio_tn_h": "double",
}
LONG_COLUMNS = [c for c, kind in COLUMN_TYPES.items() if kind == "long"]
DOUBLE_COLUMNS = [c for c, kind in COLUMN_TYPES.items() if kind == "double"]
BOOLEAN_COLUMNS = [c for c, kind in COLUMN_TYPES.items() if kind == "boolean"]

# Flags that arrive as text or boolean with gaps.
FLAG_COLUMNS = [
    "termino_carga_equipo_en_espera_cuadrado_cuadrandose_carguio",
    "cambio_estado_operatividad_carguio",
]

# Raw name -> stage name.
STAGE_NAMES = {
    "id_cargadescarga": "id_cargadescarga_ciclo",
    "termino_carga_equipo_en_espera_cuadrado_cuadrandose_carguio": "al_termino_cargar_en_espera_cuadrado_cuadrandose",
    "id_descarga": "id_zona_hace_descarga",
    "tiem_llegada_global": "tiempo_llegada_camion",
    "tiem_esperando": "tiempo_esperando_camion_en_locacion",
    "tiem_cuadra": "tiempo_cuadra_camion",
    "tiem_cuadrado": "tiempo_cuadrado_camion",
    "tiem_carga": "tiempo_cargar_al_camion",
    "tiem_acarreo": "tiempo_acarreo_camion",
    "tiem_cola": "tiempo_cola_camion_en_zonadescarga",
    "tiem_retro": "tiempo_retroceso_para_descargar",
    "tiem_listo": "tiempo_listo_para_descargar",
    "tiem_descarga": "tiempo_descarga_camion",
    "tiem_viajando": "tiempo_viajando_vacio_locacion",
    "tonelaje": "tonelaje_nominal",
    "tonelajevims": "tonelaje_segun_computadora",
    "yn_estado": "cambios_estado_en_ciclo",
    "distrealcargado": "distancia_recorrida_camioncargado_km_gps_mts",
    "distrealvacio": "distancia_recorrida_camionvacio_km_gps_mts",
    "coorxdesc": "coordenada_x_descarga_km",
    "coorydesc": "coordenada_y_descarga_km",
    "coorzdesc": "coordenada_z_descarga_km",
    "tipodescargaidentifier": "tipo_descarga_efectuado",
    "tonelajevvanterior": "tonelaje_camion_viajevacio_cicloanterior_vims",
    "tonelajevvposterior": "tonelaje_camion_viajevacio_cicloactual_vims",
    "velocidadvimscargado": "promedio_velocidad_camioncargado_km/hr_compu",
    "velocidadvimsvacio": "promedio_velocidad_camionvacio_km/hr_compu",
    "velocidadgpscargado": "promedio_velocidad_camioncargado_km/hr_gps",
    "velocidadgpsvacio": "promedio_velocidad_camionvacio_km/hr_gps",
    "tonelajevimsretain": "tonelaje_camion_antes_cargaestabilizada",
    "nivelcombuscargado": "porcentaje_combustible_camioncargando",
    "nivelcombusdescargado": "porcentaje_combustible_camiondescargando",
    "volumen": "volumen_nominal",
    "aplicafactor_vol": "aplica_factor_volumen_o_tonelaje",
    "coorzniveldescarga": "nivel_descarga_metros",
    "nombre_equipo": "nombre_equipo_acarreo",
    "id_secundario": "id_flota_secundaria",
    "flota_secundaria": "nombre_flota_secundaria",
    "id_principal": "id_flota_principal",
    "flota_principal": "nombre_flota_principal",
    "capacidad_vol_equipo": "capacidad_en_volumen_equipo_acarreo_m3",
    "capacidad_pes_equipo": "capacidad_en_peso_equipo_acarreo",
    "capacidadtanque_equipo": "capacidadtanque_equipoacarreo_galones",
    "peso_bruto_equipo": "peso_bruto_equipo_acarreo",
    "ishp_equipo": "si_no_equipo_altaprecision",
    "ancho_equipo": "ancho_equipo_metros",
    "largo_equipo": "largo_equipo_metros",
    "elevacion_descarga": "nivel_elevacion_descarga_metros",
    "nombre_descarga": "nombre_zona_descarga",
    "nombre_carga_locacion": "nombre_locacion_carga",
    "nivel_elevacion_locacion_mts": "nivel_elevacion_locacion_carga_metros",
    "radio_locacion": "radio_locacion_metros",
    "ids_poligonos_en_locacion": "ids_poligonos_en_locacion_carga",
    "id_material": "id_material_dominante_en_poligono",
    "elevacion_poligono_mts": "elevacion_poligono_metros",
    "ley_in": "lista_leyes",
    "densidad_poligono": "densidad_inicial_poligono_creado_tn/m3",
    "capacidad_vol_equipo_carguio": "capacidad_en_volumen_equipo_carguio_m3",
    "capacidad_pes_equipo_carguio": "capacidad_en_peso_equipo_carguio",
    "capacidadtanque_equipo_carguio": "capacidadtanque_equipocarguio_galones",
    "radiohexagonocuchara_equipo_carguio": "radiohexagonocuchara_equipocarguio",
    "id_tablegen": "id_guardia_acarreocarga",
    "nombre_tablegen": "nombre_guardia_acarreocarga",
    "id_guardiadescarga": "id_guardia_acarreodescarga",
    "nombre_guardiadescarga": "nombre_guardia_acarreodescarga",
    "id": "id_guardia_carguio",
    "nombre": "nombre_guardia_carguio",
    "id_locacion": "id_locacion_hace_carga",
    "tonelaje_inicial_poligono": "tonelaje_inicial_poligono_creado",
    "efhvacio": "efhvacio_mts",
    "efhcargado": "efhcargado_mts",
}

# Load starts up to this instant are out (the millisecond part matches SHIFT_MS).
FIRST_LOAD = "2023-01-01 00:00:00.999"

# Outlier bounds.
MIN_PAYLOAD = 150
PASS_TONNAGE_BAND = (180, 400)
MIN_PASSES = 4

# Stage columns that are dropped once everything is derived from them.
DROPPED_LATE = [
    "previous_esperando_pala",
    "ids_poligonos_en_locacion_carga",
    "estado_detalle_camion",
    "estado_secundario_camion",
    "estado_primario_camion",
    "estado_detalle_pala",
    "estado_secundario_pala",
    "estado_primario_pala",
    "nombre_equipo_acarreo",
    "nombre_flota_secundaria",
    "nombre_flota_principal",
    "nombre_turnocarga",
    "nombre_turnodescarga",
    "nombre_zona_descarga",
    "nombre_locacion_carga",
    "nombre_poligono",
    "lista_leyes",
    "coord_x_pases",
    "coord_y_pases",
    "coord_z_pases",
    "angulo_giro_pases",
    "duracion_excavacion_pases",
]

# Columns of the presentation layer.
PRESENTATION_COLUMNS = [
    "id_ciclo_acarreo",
    "id_cargadescarga_ciclo",
    "id_palas",
    "id_equipo_camion",
    "id_ciclo_carguio",
    "tonelaje_inicial_poligono_creado",
    "densidad_inicial_poligono_creado_tn/m3",
    "elevacion_poligono_metros",
    "id_material_dominante_en_poligono",
    "nombre_equipo_carguio",
    "capacidad_en_volumen_equipo_carguio_m3",
    "capacidad_en_peso_equipo_acarreo",
    "tiempo_carga",
    "cantidad_equipos_espera_al_termino_carga_pala",
    "horaini_turnocarga",
    "numero_pases_carguio",
    "numero_pases_carguio2",
]
