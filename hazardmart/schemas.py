"""Schemas of the staging tables, the cleansed event table and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(names: str) -> T.StructType:
    """All-string schema; every conversion happens in cleansing, never in the reader."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names.split()])


# Column names of the three staging tables.
DISASTER_STAGING = text_schema(
    """
    no entidad_federativa anio evento tipo_fenomeno instancia_corroboradora
    documento_corroboracion nombre_municipios_corroborados numero_municipios_corroborados
    instalacion_ced sectores_afectados fecha_publicacion_dof publicacion_dof
    entrega_resultados_ced limite_para_entregar_diagnostico oficio_entrega observaciones
    ultima_fecha_actualizacion
    """
)
PROJECT_STAGING = text_schema(
    """
    consecutivo entidad_federativa_solicitante instancia_publica_orden_federal_solicitante
    nombre_proyecto anio_autorizacion instancia_ejecutora tipo_proyecto tipo_fenomeno_01
    tipo_fenomeno_2 tipo_fenomeno_3 estatus personas_beneficiadas mujeres hombres
    poblacion_indigena anio_finalizacion proyecto_estrategico recurso_fondo_preventivo_federal
    recurso_coparticipacion_estatal costo_total_mxn_peso pagina_web_instancia_autorizada
    ultima_fecha_actualizacion
    """
)
EMERGENCY_STAGING = text_schema(
    """
    no entidad_federativa anio_ocurrencia_evento boletin_prensa fecha_emision_boletin_prensa
    tipo_fenomeno amenaza_natural instancia_corroboradora nombre_municipios_corroborados
    numero_municipios_corroborados oficio_poblacion_afectada poblacion_afectada
    poblacion_atendida fecha_publicacion_declaratoria_dof publicacion_dof
    instancia_que_elaboro_informe_utilizacion_insumos boletin_prensa_aviso_termino_emergencia
    fecha_emision_boletin_prensa_termino_situacion_emergencia
    fecha_publicacion_aviso_termino_declaratoria_dof publicacion_termino_dof
    total_insumos_autorizados despensas despensa_sobrevivencia despensa_mantenimiento
    alimentos_consumo_inmediato fruta_para_poblacion alimento_granel cobertor_a cobertor_b
    colchoneta hamaca lamina_tipo_a lamina_tipo_b lamina_tipo_c palma_sintetica palma_natural
    litros_agua kit_limpieza kit_aseo_personal costales saco_absorbente impermeables botas
    rollos_hule guantes_carnaza toallas_sanitarias_femeninas banieras_para_bebe panial_etapa_5
    panial_etapa_4 panial_etapa_3 panial_etapa_2 panial_etapa_1 panial_para_adulto linternas
    palas marros barretas machetes martillos carretillas cascos azadones hachas zapapicos
    motosierras mochilas_aspersores mascarillas cocinas_comunitarias
    servicios_potabilizadoras_agua servicio_bombas_extraccion_agua servicio_retroexcavadoras
    servicio_vactors envases_agua combustible fletes servicio_letrinas servicio_regaderas
    arrendamiento_montacargas arrendamiento_generadores_energia lote_insumos_para_salud
    costo_fuerzas_armadas costo_estimado_sspc costo_total_declaratoria observaciones
    """
)

AMOUNT = T.DecimalType(18, 2)
# Sums of amounts leave the library in the widest decimal, so no total can overflow.
AMOUNT_SUM = T.DecimalType(38, 2)

MEASURES = {
    "municipios_afectados": T.IntegerType(),
    "poblacion_afectada": AMOUNT,
    "poblacion_atendida": AMOUNT,
    "costo_total": AMOUNT,
    "cantidad_eventos": T.IntegerType(),
}
EVENT_KEYS = {
    "estado": T.StringType(),
    "anio": T.IntegerType(),
    "fenomeno": T.StringType(),
    "tipo_evento": T.StringType(),
}
EVENT_ID = "id_evento"
# The nine columns every cleansed source is reduced to.
EVENTS = T.StructType(
    [T.StructField(name, kind) for name, kind in {**EVENT_KEYS, **MEASURES}.items()]
)

# Star-schema tables, their keys and declared text lengths.
DIMENSION_KEYS = {
    "dim_estado": ("id_estado", "estado"),
    "dim_tiempo": ("id_tiempo", "anio"),
    "dim_fenomeno": ("id_fenomeno", "tipo_fenomeno"),
    "dim_tipo_evento": ("id_tipo_evento", "tipo_evento"),
}
FACT_TABLE = "fact_eventos_desastres"
FACT_KEYS = [id_column for id_column, _ in DIMENSION_KEYS.values()]
TEXT_LENGTHS = {"estado": 100, "tipo_fenomeno": 200, "tipo_evento": 50}
STAR_TABLES = [*DIMENSION_KEYS, FACT_TABLE]
