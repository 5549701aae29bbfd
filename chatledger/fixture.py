"""The message log that the registered queries run on, derived from ``events``.

It is dirty on purpose: text case numbers and times, blanks, unusable rows and
exact copies under a new id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatledger.operators.cleaning import clean_messages

PERIODS = (
    ("2024-01-01", "2024-01-02"),
    ("2024-01-02", "2024-01-04"),
    ("2024-01-04", "2024-01-30"),
)
CALC_TIMES = ("2024-02-01 08:00:00", "2024-02-02 08:00:00", "2024-02-03 08:00:00")
PERIOD_KEYS = ("periodo_desde", "periodo_hasta", "calc_ts", "nro_caso")

_START = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
_DAYS = "CASE WHEN user_id % 7 = 6 THEN 30 ELSE 1 + user_id % 7 END"
_CLIENT = "event_type IN ('click', 'view')"
_SHIFT = "user_id % 5 * 86400 + user_id % 24 * 3600"
_SECONDS = (
    f"CASE WHEN user_id % 10 = 0 THEN off WHEN user_id % 10 <= 3 THEN {_SHIFT} + off div 600"
    f" ELSE {_SHIFT} + off div 60 END"
)
_COLUMNS = f"""struct(
  event_id AS id,
  CASE WHEN event_id % 211 = 5 THEN NULL WHEN event_id % 223 = 5 THEN 'x12'
       ELSE CAST(user_id * 100 + off div (86400 * {_DAYS}) AS STRING) END AS nro_caso,
  CASE WHEN event_id % 227 <> 5
       THEN CAST(timestampadd(SECOND, {_SECONDS}, {_START}) AS STRING) END AS fecha_creacion,
  CASE WHEN event_id % 101 = 7 THEN 'OTHER' WHEN {_CLIENT} THEN ' inbound '
       ELSE 'OUTBOUND' END AS direccionamiento,
  CASE WHEN event_type = 'purchase' THEN concat(' AGENTE ', user_id % 5, ' - a@example.com ')
       WHEN event_type = 'error' THEN NULL ELSE 'SAGICC SISTEMA' END AS usuario,
  CASE WHEN k < 10 THEN NULL WHEN k < 12 THEN '' ELSE concat('CANAL ', k % 3) END AS canal,
  CASE WHEN k % 9 <> 0 THEN concat(' CAMP ', user_id % 4) END AS campania,
  CASE WHEN event_id % 307 = 5 THEN repeat('x', 5000)
       WHEN user_id % 11 = 3 AND {_CLIENT} THEN 'me llega la copia de la factura'
       WHEN k < 5 THEN NULL
       WHEN k < 10 THEN concat('foto_', k, '.jpg')
       WHEN k < 15 THEN 'Hola!'
       WHEN k < 20 THEN 'gracias por todo'
       WHEN k < 35 THEN concat('precio del combo ', k)
       WHEN k < 50 THEN concat('parce, el turno ', k)
       WHEN k < 53 THEN 'Llamada Saliente'
       ELSE concat('mensaje ', k) END AS contenido)"""


def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        f"CAST(floor(CAST(CAST(ts AS TIMESTAMP_NTZ) - {_START} AS DECIMAL(18, 6))) AS BIGINT) AS off",
    )
    rows = base.selectExpr(f"{_COLUMNS} AS m")
    return rows.selectExpr(
        "inline(CASE WHEN m.id % 13 = 0 THEN array(m, struct(m.id + 1000000000 AS id,"
        " m.nro_caso, m.fecha_creacion, m.direccionamiento, m.usuario, m.canal, m.campania,"
        " m.contenido)) ELSE array(m) END)"
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_messages(source_messages(spark, sf_dir))


def period_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages once per period they fall in, with the period and its run time."""
    periods = ", ".join(
        f"struct(DATE'{since}' AS periodo_desde, DATE'{until}' AS periodo_hasta,"
        f" TIMESTAMP_NTZ'{calc}' AS calc_ts)"
        for (since, until), calc in zip(PERIODS, CALC_TIMES)
    )
    day = "CAST(fecha_creacion AS DATE)"
    hit = (
        f"filter(array({periods}),"
        f" p -> {day} >= p.periodo_desde AND {day} <= p.periodo_hasta)"
    )
    return interactions(spark, sf_dir).selectExpr("*", f"inline({hit})")
