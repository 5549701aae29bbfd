"""Outcome and metrics per case (C1, C2, and the case-level parts of §2.6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger.functions import numbers as N
from chatledger.functions.calendar import ntz
from chatledger.functions.text import agent_name
from chatledger.operators.grains import CASE, case_facts
from chatledger.rules import DEFAULT_RULES, Rules
from chatledger.schemas import METRICS

SINGLE_MESSAGE = "mensaje_unico"  # a case left out without any audit category

# Why a case yields no metrics, the first rule that holds; null when it does.
DISCARD_REASON = f"""CASE
  WHEN hubo_llamada AND (cliente = 0 OR bot + humano = 0) THEN 'llamada'
  WHEN total = 0 THEN 'vacio'
  WHEN total = 1 THEN '{SINGLE_MESSAGE}'
  WHEN hueco_largo THEN 'fechas_incoherentes'
  WHEN bot + humano = 0 THEN 'solo_inbound'
  WHEN cliente = 0 THEN 'solo_outbound'
  WHEN textos >= 2 AND texto_unico THEN 'mensaje_repetido'
  WHEN NOT venta AND colaborador THEN 'colaborador'
  WHEN NOT venta THEN 'sin_palabras_venta'
  WHEN t_humano IS NULL THEN 'sin_atencion_humana'
END"""


def categories(rules: Rules = DEFAULT_RULES) -> str:
    """Audit categories of a case in the order in which they are tagged."""
    return f"""array_compact(array(
      CASE WHEN hubo_llamada AND NOT motivo_descarte <=> 'llamada' THEN 'con_llamada' END,
      CASE WHEN dup_sustantivo AND (motivo_descarte IS NULL OR motivo_descarte IN
        ('solo_inbound', 'colaborador', 'sin_palabras_venta', 'sin_atencion_humana'))
        THEN 'duplicados' END,
      nullif(motivo_descarte, '{SINGLE_MESSAGE}'),
      CASE WHEN motivo_descarte IS NULL AND t_bot IS NULL THEN 'sin_bot' END,
      CASE WHEN motivo_descarte IS NULL AND total > {rules.long_case_messages}
        THEN 'extraordinario' END))"""


def metric_columns(calc_ts: dt.datetime | str | Column | None = None) -> dict[str, Column]:
    """The 23 metrics by name, in order, over ``judged_cases``."""
    if calc_ts is None:
        calc_ts = F.localtimestamp()
    elif not isinstance(calc_ts, Column):
        calc_ts = F.expr(ntz(calc_ts))
    sql = {
        "nro_caso": "nro_caso",
        "primera_interaccion_cliente": "t0",
        "primera_interaccion_bot": "t_bot",
        "primera_interaccion_humano": "t_humano",
        "ultima_interaccion": "ultima_fecha",
        "ftr_bot_min": N.round3("minutos_bot"),
        "tfr_human_min": N.round3("minutos_humano"),
        "tiempo_promedio_de_interaccion_min": N.round3("minutos_total"),
        "canal_primera_interaccion": "primer_canal",
        "campania": "primera_campania",
        "total_mensajes": "total",
        "mensajes_cliente": "cliente",
        "mensajes_bot": "bot",
        "mensajes_humano": "humano",
        "mensajes_multimedia": "multimedia",
        "atendido_por_humano": "true",
        "cumple_min_mensajes": "total > 2",
        "es_venta": "true",
        "fecha_calculo": None,
        "tiempo_promedio_entre_mensajes_min": "pausa_media",
        "icc_score": N.engagement_score("pausa_media"),
        "agente": agent_name("usuario_humano"),
        "tuvo_bot": "t_bot IS NOT NULL",
    }
    return {n: calc_ts if n == "fecha_calculo" else F.expr(sql[n]) for n in METRICS.names}


def judged_cases(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """``case_facts`` plus discard reason, categories, durations and mean gap."""
    return (
        case_facts(messages, rules, keys)
        .selectExpr(
            "*",
            f"{DISCARD_REASON} AS motivo_descarte",
            f"{N.minutes_unrounded('t0', 't_bot')} AS minutos_bot",
            f"{N.minutes_unrounded('t0', 't_humano')} AS minutos_humano",
            f"{N.minutes_unrounded('primera_fecha', 'ultima_fecha')} AS minutos_total",
            f"{N.mean_gap_unrounded('primera_fecha', 'ultima_fecha', 'total')} AS minutos_pausa",
        )
        .selectExpr(
            "*",
            f"{categories(rules)} AS categorias",
            "motivo_descarte IS NOT NULL AS descartado",
            f"{N.round3('minutos_pausa')} AS pausa_media",
        )
    )


def _outcome(keys: Sequence[str]) -> list[str]:
    return [
        *keys,
        "categorias",
        "motivo_descarte",
        "descartado",
        "duplicados AS duplicados_eliminados",
        "fecha_caso",
        "campania_caso",
        "canal_caso",
    ]


def classify_cases(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """One row per case with its categories and whether it was left out."""
    return judged_cases(messages, rules, keys).selectExpr(*_outcome(keys))


def case_metrics(
    messages: DataFrame,
    calc_ts: dt.datetime | str | Column | None = None,
    rules: Rules = DEFAULT_RULES,
    keys: Sequence[str] = CASE,
) -> DataFrame:
    """The 23-column metrics table of the cases that were kept."""
    metrics = metric_columns(calc_ts)
    extra = [k for k in keys if k not in metrics]
    return (
        judged_cases(messages, rules, keys)
        .where("NOT descartado")
        .select(*extra, *[c.alias(n) for n, c in metrics.items()])
    )


def case_results(
    messages: DataFrame,
    calc_ts: dt.datetime | str | Column | None = None,
    rules: Rules = DEFAULT_RULES,
    keys: Sequence[str] = CASE,
) -> DataFrame:
    """C1 and C2 in one pass: the outcome, and the metrics as a struct that is
    null for cases left out. Store it once; metrics, audit and summary are then
    narrow reads."""
    metrics = metric_columns(calc_ts)
    body = F.struct(*[c.alias(n) for n, c in metrics.items() if n != "nro_caso"])
    outcome = [F.expr(sql) for sql in _outcome(keys)]
    return judged_cases(messages, rules, keys).select(
        *outcome, F.when(F.expr("NOT descartado"), body).alias("metricas")
    )


def metrics_from_results(results: DataFrame) -> DataFrame:
    return results.where("NOT descartado").select("nro_caso", "metricas.*")


def case_outcomes(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Number of cases by final outcome."""
    return (
        classify_cases(messages, rules)
        .groupBy(F.expr("coalesce(motivo_descarte, 'metricas') AS resultado"))
        .agg(F.count("*").alias("casos"))
    )
