"""Declared schemas. Nothing is inferred, so empty periods stay readable. Column names and types
are fixed values: they are the tables that other programs read."""

from __future__ import annotations

from pyspark.sql import types as T

_NTZ = T.TimestampNTZType()
_STR = T.StringType()
_LONG = T.LongType()
_DBL = T.DoubleType()
_BOOL = T.BooleanType()
_INT = T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SOURCE_COLUMNS = (
    "id", "nro_caso", "fecha_creacion", "direccionamiento",
    "usuario", "canal", "campania", "contenido",
)

# ``id`` is kept next to the seven message columns: it orders messages of one instant.
MESSAGES = _struct(
    ("id", _LONG),
    ("nro_caso", _LONG),
    ("fecha_creacion", _NTZ),
    ("direccionamiento", _STR),
    ("usuario", _STR),
    ("canal", _STR),
    ("campania", _STR),
    ("contenido", _STR),
)

METRICS = _struct(
    ("nro_caso", _LONG),
    ("primera_interaccion_cliente", _NTZ),
    ("primera_interaccion_bot", _NTZ),
    ("primera_interaccion_humano", _NTZ),
    ("ultima_interaccion", _NTZ),
    ("ftr_bot_min", _DBL),
    ("tfr_human_min", _DBL),
    ("tiempo_promedio_de_interaccion_min", _DBL),
    ("canal_primera_interaccion", _STR),
    ("campania", _STR),
    ("total_mensajes", _LONG),
    ("mensajes_cliente", _LONG),
    ("mensajes_bot", _LONG),
    ("mensajes_humano", _LONG),
    ("mensajes_multimedia", _LONG),
    ("atendido_por_humano", _BOOL),
    ("cumple_min_mensajes", _BOOL),
    ("es_venta", _BOOL),
    ("fecha_calculo", _NTZ),
    ("tiempo_promedio_entre_mensajes_min", _DBL),
    ("icc_score", _INT),
    ("agente", _STR),
    ("tuvo_bot", _BOOL),
)

REPORT = T.StructType(
    METRICS.fields
    + _struct(
        ("primera_interaccion - format", _STR),
        ("Rango Horario (2h)", _STR),
        ("primera_interaccion_hora", _DBL),
        ("rangos_hora_atencion", _STR),
        ("HoraMinuto", _INT),
        ("tfr_human_rango", _STR),
        ("Orden_rango", _INT),
        ("canal", _STR),
        ("clasificacion_tiempo_entre", _STR),
        ("Orden_clasif_tiempo", _INT),
    ).fields
)

CASES = _struct(
    ("nro_caso", _LONG),
    ("fecha", _NTZ),
    ("campania", _STR),
    ("canal", _STR),
    ("atendido", _BOOL),
    ("categoria_no_atendida", _STR),
    ("Rango Horario (2h)", _STR),
)

AUDIT = _struct(
    ("nro_caso", _LONG),
    ("fecha", _STR),
    ("campania", _STR),
    ("canal", _STR),
    ("seccion", _STR),
)

AUDIT_MASTER = T.StructType(AUDIT.fields + _struct(("periodo", _STR)).fields)

# One row per case as the period job stores it: outcome plus the (nullable) metrics.
CASE_RESULTS = T.StructType(
    _struct(
        ("nro_caso", _LONG),
        ("categorias", T.ArrayType(_STR)),
        ("motivo_descarte", _STR),
        ("descartado", _BOOL),
        ("duplicados_eliminados", _LONG),
        ("fecha_caso", _NTZ),
        ("campania_caso", _STR),
        ("canal_caso", _STR),
    ).fields
    + [T.StructField("metricas", T.StructType(METRICS.fields[1:]), True)]
)
