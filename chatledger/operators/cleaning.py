"""From source rows to clean messages (P1-P5, S2). No shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger.functions import calendar as C
from chatledger.functions.text import strip
from chatledger.schemas import SOURCE_COLUMNS


def source_projection(rows: DataFrame) -> DataFrame:
    """The eight source columns, so that a scan reads nothing else."""
    return rows.select(*SOURCE_COLUMNS)


PARSED_CASE = "try_cast(nro_caso AS BIGINT)"
CLEAN_DIRECTION = f"upper({strip('direccionamiento')})"


def parsed_time(rows: DataFrame) -> str:
    """The message time without zone; an unreadable text is null."""
    if not isinstance(rows.schema["fecha_creacion"].dataType, T.StringType):
        return "CAST(fecha_creacion AS TIMESTAMP_NTZ)"
    text = strip("fecha_creacion")
    # the cast alone would also take '2024' or '2024-1-1'
    return (
        f"CASE WHEN length({text}) >= 10 AND substring({text}, 5, 1) = '-'"
        f" AND substring({text}, 8, 1) = '-' THEN {C.lenient_timestamp(text)} END"
    )


def clean_label(name: str) -> str:
    """P5: blanks at the ends go; '' is null, but an all-blank value becomes ''."""
    return f"CASE WHEN {name} <> '' THEN {strip(name)} END"


def reject_reason(rows: DataFrame) -> str:
    """Why a row is unusable, null for a usable one."""
    return (
        "CASE WHEN nro_caso IS NULL THEN 'sin_caso' WHEN fecha_creacion IS NULL THEN 'sin_fecha'"
        f" WHEN coalesce({CLEAN_DIRECTION} NOT IN ('INBOUND', 'OUTBOUND'), true)"
        " THEN 'direccion_desconocida'"
        f" WHEN {PARSED_CASE} IS NULL THEN 'caso_ilegible'"
        f" WHEN {parsed_time(rows)} IS NULL THEN 'fecha_ilegible' END"
    )


def valid_rows(rows: DataFrame) -> DataFrame:
    """Usable rows, untouched."""
    return rows.where(
        f"nro_caso IS NOT NULL AND fecha_creacion IS NOT NULL"
        f" AND {CLEAN_DIRECTION} IN ('INBOUND', 'OUTBOUND')"
        f" AND {PARSED_CASE} IS NOT NULL AND {parsed_time(rows)} IS NOT NULL"
    )


def rejected_counts(rows: DataFrame) -> DataFrame:
    """Number of rejected rows by reason."""
    return (
        rows.selectExpr(f"{reject_reason(rows)} AS motivo")
        .where("motivo IS NOT NULL")
        .groupBy("motivo")
        .agg(F.count("*").alias("filas"))
    )


def clean_messages(rows: DataFrame) -> DataFrame:
    """P2 + P3 + P5: usable rows as typed messages."""
    return valid_rows(rows).selectExpr(
        "CAST(id AS BIGINT) AS id",
        f"{PARSED_CASE} AS nro_caso",
        f"{C.truncate_millis(parsed_time(rows))} AS fecha_creacion",
        f"{CLEAN_DIRECTION} AS direccionamiento",
        f"{clean_label('usuario')} AS usuario",
        f"{clean_label('canal')} AS canal",
        f"{clean_label('campania')} AS campania",
        "CAST(contenido AS STRING) AS contenido",
    )


def messages_between(messages: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """Messages of both days and all days between."""
    return messages.where(C.in_date_range("fecha_creacion", since, until))


def rows_between(rows: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """P1 on source rows. On a column that already is a time this is a plain
    comparison, so Parquet and JDBC sources apply it themselves."""
    return rows.where(C.in_date_range(f"({parsed_time(rows)})", since, until))


def count_between(rows: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """Number of source rows in the range, before any cleaning."""
    return rows_between(rows, since, until).agg(F.count("*").alias("total"))
