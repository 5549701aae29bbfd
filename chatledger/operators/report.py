"""Reporting tables (C4, C5, W6, U2). C4 is a projection without any shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger import rules as R
from chatledger.functions import calendar as C
from chatledger.functions import numbers as N
from chatledger.functions.text import label_missing, quoted
from chatledger.schemas import CASES


def build_report(metrics: DataFrame) -> DataFrame:
    """C4: the metrics and ten columns for dashboards."""
    first = "primera_interaccion_cliente"
    reply, pace = "tfr_human_min", "tiempo_promedio_entre_mensajes_min"
    added = {
        "primera_interaccion - format": C.day_month_year(first),
        "Rango Horario (2h)": C.two_hour_block(first),
        "primera_interaccion_hora": C.day_fraction(first),
        "rangos_hora_atencion": C.nearest_quarter(first),
        "HoraMinuto": C.minute_of_day(first),
        "tfr_human_rango": N.response_band(reply),
        "Orden_rango": N.response_band_order(reply),
        "canal": "canal_primera_interaccion",
        "clasificacion_tiempo_entre": N.pace_band(pace),
        "Orden_clasif_tiempo": N.pace_band_order(pace),
    }
    if "agente" in metrics.columns:
        added["agente"] = label_missing("agente", R.NO_AGENT)
    return metrics.withColumns({name: F.expr(sql) for name, sql in added.items()})


def attended_cases(metrics: DataFrame) -> DataFrame:
    return metrics.selectExpr(
        "nro_caso",
        "primera_interaccion_cliente AS fecha",
        "campania",
        "canal_primera_interaccion AS canal",
        "true AS atendido",
        "CAST(NULL AS STRING) AS categoria_no_atendida",
    )


def not_attended_cases(audit: DataFrame) -> DataFrame:
    """Cases nobody attended, each in its first section by priority.

    ``row_number() = 1`` lets Spark keep only the best row per case in every map
    task before it shuffles, so a case listed very often stays cheap. Of several entries
    in one section those without a date come last, then the earliest wins."""
    listed = ", ".join(quoted(s) for s in R.NOT_ATTENDED_SECTIONS)
    return (
        audit.where(f"seccion IN ({listed})")
        .selectExpr("*", f"array_position(array({listed}), seccion) AS prioridad")
        .selectExpr(
            "*",
            "row_number() OVER (PARTITION BY nro_caso"
            " ORDER BY prioridad, nullif(fecha, '') NULLS LAST, campania, canal) AS rn",
        )
        .where("rn = 1")
        .selectExpr(
            "nro_caso",
            f"{C.lenient_timestamp('fecha')} AS fecha",
            "campania",
            "canal",
            "false AS atendido",
            "seccion AS categoria_no_atendida",
        )
    )


def build_cases(metrics: DataFrame, audit: DataFrame) -> DataFrame:
    """C5 + U2: attended and not attended cases in one table."""
    return _labelled(attended_cases(metrics).unionByName(not_attended_cases(audit)))


def cases_from_results(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """C5 + U2 straight from ``case_results``, in one narrow pass: a case is attended, or
    it is in at most one section of those nobody attended, its first by priority.
    ``keys`` are carried along, such as the columns of the period."""
    first = " ".join(
        f"WHEN array_contains(categorias, {quoted(category)}) THEN {quoted(section)}"
        for section in R.NOT_ATTENDED_SECTIONS
        for category, name in R.SECTIONS.items()
        if name == section
    )
    rows = results.selectExpr("*", f"CASE WHEN descartado THEN CASE {first} END END AS seccion")
    listed = C.lenient_timestamp(C.minute_text("fecha_caso"))
    both = rows.where("NOT descartado OR seccion IS NOT NULL").selectExpr(
        *keys,
        "nro_caso",
        f"CASE WHEN descartado THEN {listed} ELSE metricas.primera_interaccion_cliente END AS fecha",
        "CASE WHEN descartado THEN campania_caso ELSE metricas.campania END AS campania",
        "CASE WHEN descartado THEN canal_caso ELSE metricas.canal_primera_interaccion END AS canal",
        "NOT descartado AS atendido",
        "seccion AS categoria_no_atendida",
    )
    return _labelled(both, keys)


def _labelled(both: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return both.selectExpr(
        *keys,
        "nro_caso",
        "fecha",
        f"{label_missing('campania', R.NO_CAMPAIGN)} AS campania",
        f"{label_missing('canal', R.NO_CHANNEL)} AS canal",
        "atendido",
        "categoria_no_atendida",
        f"{C.two_hour_block('fecha')} AS `Rango Horario (2h)`",
    ).select(*keys, *CASES.names)
