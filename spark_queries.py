"""The registered queries: one per operator, over the whole ``events`` table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger import fixture as X
from chatledger.functions import calendar as C
from chatledger.functions import numbers as N
from chatledger.functions import text as T
from chatledger import rules as R
from chatledger.operators import audit as A
from chatledger.operators import classify as K
from chatledger.operators import cleaning as L
from chatledger.operators import grains as G
from chatledger.operators import report as B
from chatledger.operators import unify as U
from chatledger.plans import period as P
from chatledger.schemas import (
    AUDIT, CASES, MESSAGES, METRICS, REPORT,
)
from chatledger.sources import audits, tables
from chatledger.sources.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

CALC = "2024-02-01 08:00:00"
PERIODS = [tuple(dt.date.fromisoformat(d) for d in pair) for pair in X.PERIODS]
SECOND = PERIODS[1]
PERIOD_COLS = ["periodo_desde", "periodo_hasta"]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return X.interactions(spark, sf).selectExpr("id", f"{T.normalize('contenido')} AS texto")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    return G.case_facts(X.interactions(spark, sf))


def one_audit(spark: SparkSession, sf: str) -> DataFrame:
    return A.audit_rows(K.classify_cases(X.interactions(spark, sf)))


def period_results(spark: SparkSession, sf: str) -> DataFrame:
    """Case results of the three overlapping periods, analysed in one job."""
    return K.case_results(
        X.period_messages(spark, sf), F.col("calc_ts"), keys=X.PERIOD_KEYS
    )


def stored_results(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, str]:
    """The same, written once, for queries that read it several times."""
    base = scratch_dir(spark, name)
    results = period_results(spark, sf)
    results.write.parquet(f"{base}/resultados")
    return spark.read.schema(results.schema).parquet(f"{base}/resultados"), base


def all_results(spark: SparkSession, sf: str) -> DataFrame:
    """Case results of all messages as one period."""
    return K.case_results(X.interactions(spark, sf), CALC)


def kept(results: DataFrame) -> DataFrame:
    return results.where("NOT descartado").select(*PERIOD_COLS, "nro_caso", "metricas.*")


def of_period(table: DataFrame, period) -> DataFrame:
    return table.where(U.one_of([period])).drop(*PERIOD_COLS)


def with_period(results: DataFrame) -> DataFrame:
    return results.selectExpr("*", f"{C.period_key('periodo_desde', 'periodo_hasta')} AS periodo")


def period_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return kept(period_results(spark, sf))


def master(spark: SparkSession, sf: str) -> DataFrame:
    return A.audit_rows(with_period(period_results(spark, sf)))


def period_cases(spark: SparkSession, sf: str) -> DataFrame:
    """The cases tables of the three periods with their period columns."""
    return B.cases_from_results(period_results(spark, sf), PERIOD_COLS)


# --- sources -----------------------------------------------------------------


@query
def s2_count_between(spark, sf):
    return L.count_between(X.source_messages(spark, sf), *SECOND)


@query
def s3_raw_scan(spark, sf):
    base = scratch_dir(spark, "s3")
    messages = X.interactions(spark, sf)
    for period in PERIODS:
        tables.write_period(L.messages_between(messages, *period), base, *period, MESSAGES)
    return tables.read_period(spark, base, *SECOND, MESSAGES)


@query
def s4_metrics_scan(spark, sf):
    base = scratch_dir(spark, "s4")
    messages = L.messages_between(X.interactions(spark, sf), *SECOND)
    tables.write_period(K.case_metrics(messages, X.CALC_TIMES[1]), base, *SECOND, METRICS)
    return tables.read_period(spark, base, *SECOND, METRICS)


@query
def s5_audit_json(spark, sf):
    base = scratch_dir(spark, "s5")
    audits.write_audit(one_audit(spark, sf), f"{base}/json", f"{base}/csv")
    return audits.read_audit(spark, f"{base}/json")


def _stored_master(spark, sf, name) -> str:
    results, base = stored_results(spark, sf, name)
    for period in PERIODS:
        audits.upsert_period(
            A.audit_rows(of_period(results, period)), f"{base}/general", P.period_key(*period)
        )
    return f"{base}/general"


@query
def s6_audit_master(spark, sf):
    return audits.read_master(spark, _stored_master(spark, sf, "s6"))


def _stored_reports(spark, sf, name) -> str:
    results, base = stored_results(spark, sf, name)
    report = B.build_report(kept(results))
    for period in PERIODS:
        tables.write_period(of_period(report, period), f"{base}/reporte", *period, REPORT)
    return f"{base}/reporte"


@query
def s7_report_discovery(spark, sf):
    return tables.list_periods(spark, _stored_reports(spark, sf, "s7"))


@query
def s8_period_selection(spark, sf):
    base = _stored_reports(spark, sf, "s8")
    found = U.select_periods(
        tables.read_periods(spark, base, REPORT), dt.date(2024, 1, 1), dt.date(2024, 1, 4)
    )
    return found.select(*PERIOD_COLS, "nro_caso", "total_mensajes")


# --- sinks, read back --------------------------------------------------------


@query
def k1_raw_sink(spark, sf):
    base = scratch_dir(spark, "k1")
    messages = X.interactions(spark, sf)
    # the first period is written twice: a re-run must not add rows
    for period in [PERIODS[0], *PERIODS]:
        tables.write_period(L.messages_between(messages, *period), base, *period, MESSAGES)
    return tables.read_periods(spark, base, MESSAGES)


@query
def k2_raw_csv(spark, sf):
    path = scratch_dir(spark, "k2") + "/csv"
    lines = tables.one_line_texts(X.interactions(spark, sf)).drop("id")
    tables.write_csv(lines, path)
    return tables.read_csv(spark, path, lines.schema)


@query
def k3_metrics_csv(spark, sf):
    path = scratch_dir(spark, "k3") + "/csv"
    tables.write_csv(K.case_metrics(X.interactions(spark, sf), CALC).select(*METRICS.names), path)
    return tables.read_csv(spark, path, METRICS)


@query
def k4_audit_csv(spark, sf):
    base = scratch_dir(spark, "k4")
    audits.write_audit(one_audit(spark, sf), f"{base}/json", f"{base}/csv")
    return tables.read_csv(
        spark, f"{base}/csv", A.flat_audit(spark.createDataFrame([], AUDIT)).schema
    )


@query
def k5_report_sink(spark, sf):
    base = _stored_reports(spark, sf, "k5")
    return tables.read_periods(spark, base, REPORT)


@query
def k6_cases_sink(spark, sf):
    results, base = stored_results(spark, sf, "k6")
    for period in PERIODS:
        own = of_period(results, period)
        table = B.build_cases(K.metrics_from_results(own), A.audit_rows(own))
        tables.write_period(table, base + "/casos", *period, CASES)
    return tables.read_periods(spark, base + "/casos", CASES)


@query
def k7_unified_sink(spark, sf):
    base = _stored_reports(spark, sf, "k7")
    unified = U.unify(tables.read_periods(spark, base, REPORT), U.REPORTS)
    tables.write_sorted(unified, f"{base}_unificado")
    return tables.read_sorted(spark, f"{base}_unificado", REPORT).drop(tables.ORDER_COLUMN)


def _section_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("periodo", "seccion").agg(F.count("*").alias("casos"))


@query
def k8_audit_upsert(spark, sf):
    base = _stored_master(spark, sf, "k8")
    # once more for one period: it replaces, it does not add
    again = A.audit_rows(
        K.classify_cases(L.messages_between(X.interactions(spark, sf), *PERIODS[0]))
    )
    audits.upsert_period(again, base, P.period_key(*PERIODS[0]))
    return _section_counts(audits.read_master(spark, base))


@query
def k9_remove_period(spark, sf):
    base = _stored_master(spark, sf, "k9")
    audits.remove_period(spark, base, P.period_key(*SECOND))
    return _section_counts(audits.read_master(spark, base))


# --- projections, filters, predicates ----------------------------------------


@query
def p1_date_range(spark, sf):
    return L.messages_between(X.interactions(spark, sf), *SECOND).select(
        "id", "nro_caso", "fecha_creacion"
    )


@query
def p2_projection(spark, sf):
    return L.source_projection(X.source_messages(spark, sf))


@query
def p3_valid_rows(spark, sf):
    return L.valid_rows(X.source_messages(spark, sf))


@query
def p4_rejected_counts(spark, sf):
    return L.rejected_counts(X.source_messages(spark, sf))


@query
def p5_normalised_fields(spark, sf):
    return X.interactions(spark, sf)


@query
def p6_text_normalise(spark, sf):
    return texts(spark, sf)


@query
def p7_contains_term(spark, sf):
    return texts(spark, sf).selectExpr(
        "id",
        f"{T.contains_any('texto', R.SALES_TERMS)} AS venta",
        f"{T.contains_any('texto', R.COLLEAGUE_TERMS)} AS colaborador",
    )


@query
def p8_call_marker(spark, sf):
    return texts(spark, sf).selectExpr("id", f"{T.is_call_marker('texto')} AS marcador")


@query
def p9_system_user(spark, sf):
    return X.interactions(spark, sf).selectExpr("id", f"{T.is_system_user('usuario')} AS sistema")


@query
def p10_speaker(spark, sf):
    return X.interactions(spark, sf).selectExpr(
        "id", f"{T.speaker('direccionamiento', 'usuario')} AS rol"
    )


@query
def p11_trivial(spark, sf):
    return texts(spark, sf).selectExpr("id", f"{T.is_trivial('texto')} AS trivial")


@query
def p12_multimedia(spark, sf):
    return texts(spark, sf).selectExpr("id", f"{T.is_multimedia('texto')} AS multimedia")


def _over_texts(name: str, keys: tuple[str, ...]) -> Query:
    """P6-P8, P11, P12 over every whole text of a given table. The normalised text is
    returned as its digest and length."""

    def run(spark, sf):
        rows = spark.read.parquet(f"{sf}/{name}.parquet").selectExpr(*keys, f"{T.normalize('text')} AS texto")
        return rows.selectExpr(
            *keys,
            "md5(texto) AS texto_md5",
            "CAST(length(texto) AS BIGINT) AS largo",
            f"{T.contains_any('texto', R.SALES_TERMS)} AS venta",
            f"{T.contains_any('texto', R.COLLEAGUE_TERMS)} AS colaborador",
            f"{T.is_call_marker('texto')} AS marcador",
            f"{T.is_trivial('texto')} AS trivial",
            f"{T.is_multimedia('texto')} AS multimedia",
        )

    return run


_QUERIES["p_text_predicates_documents"] = _over_texts("documents", ("doc_id",))
_QUERIES["p_text_predicates_conversations"] = _over_texts("conversations", ("conv_id", "turn"))


# --- scalar functions --------------------------------------------------------

TS = "CAST(ts AS TIMESTAMP_NTZ)"


def over_events(spark, sf, **expressions: str) -> DataFrame:
    return events(spark, sf).selectExpr(
        "event_id", *[f"{sql} AS {name}" for name, sql in expressions.items()]
    )


@query
def f1_minutes_between(spark, sf):
    return over_events(spark, sf, minutos=N.minutes_between(C.ntz("2024-01-01 00:00:00"), TS))


@query
def f2_engagement_score(spark, sf):
    return over_events(spark, sf, icc_score=N.engagement_score("value"))


@query
def f3_agent_name(spark, sf):
    return X.interactions(spark, sf).selectExpr("id", f"{T.agent_name('usuario')} AS agente")


@query
def f4_two_hour_block(spark, sf):
    return over_events(spark, sf, bloque=C.two_hour_block(TS))


@query
def f5_day_fraction(spark, sf):
    return over_events(spark, sf, fraccion=C.day_fraction(TS))


@query
def f6_minute_of_day(spark, sf):
    return over_events(spark, sf, minuto=C.minute_of_day(TS))


@query
def f7_nearest_quarter(spark, sf):
    return over_events(spark, sf, cuarto=C.nearest_quarter(TS))


@query
def f8_response_band(spark, sf):
    return over_events(
        spark, sf, rango=N.response_band("value"), orden=N.response_band_order("value")
    )


@query
def f9_pace_band(spark, sf):
    return over_events(spark, sf, rango=N.pace_band("value"), orden=N.pace_band_order("value"))


@query
def f10_day_month_year(spark, sf):
    return over_events(spark, sf, fecha=C.day_month_year(TS))


@query
def f11_minute_text(spark, sf):
    rows = X.source_messages(spark, sf)
    return rows.selectExpr("id", f"{C.minute_text(L.parsed_time(rows))} AS fecha")


@query
def f12_lenient_timestamp(spark, sf):
    text = "CASE WHEN id % 3 = 0 THEN direccionamiento ELSE coalesce(fecha_creacion, '') END"
    return X.source_messages(spark, sf).selectExpr("id", f"{C.lenient_timestamp(text)} AS fecha")


@query
def f13_missing_labels(spark, sf):
    return X.interactions(spark, sf).selectExpr(
        "id",
        f"{T.label_missing('campania', R.NO_CAMPAIGN)} AS campania",
        f"{T.label_missing('canal', R.NO_CHANNEL)} AS canal",
        f"{T.label_missing(T.agent_name('usuario'), R.NO_AGENT)} AS agente",
    )


DAY = "CAST(ts AS DATE)"
KEY = C.period_key(DAY, f"date_add({DAY}, 1)")


@query
def f14_period_names(spark, sf):
    return over_events(spark, sf, clave=KEY, etiqueta=C.period_label(KEY))


@query
def f15_period_from_name(spark, sf):
    name = f"""CASE WHEN event_id % 5 = 0 THEN 'reporte_unificado.parquet'
      WHEN event_id % 2 = 0 THEN concat('reporte_', translate({KEY}, '-', '_'), '.parquet')
      ELSE concat('reporte_', {KEY}, '.parquet') END"""
    since, until = C.period_from_name(name)
    return over_events(spark, sf, desde=since, hasta=until)


# --- joins -------------------------------------------------------------------


@query
def j1_category_sections(spark, sf):
    names = A.sections(spark).select("seccion", "categoria")
    counts = one_audit(spark, sf).groupBy("seccion").agg(F.count("*").alias("casos"))
    return counts.join(F.broadcast(names), "seccion").select("categoria", "seccion", "casos")


@query
def j2_section_details(spark, sf):
    other = F.expr("CASE WHEN nro_caso % 5 = 0 THEN 'casos_otros' ELSE seccion END")
    return A.with_section_order(one_audit(spark, sf).withColumn("seccion", other)).select(
        "nro_caso", "seccion", "orden", "descripcion"
    )


@query
def j3_first_replies(spark, sf):
    return facts(spark, sf).select("nro_caso", "t0", "t_humano", "usuario_humano", "t_bot")


# --- aggregations ------------------------------------------------------------


@query
def a1_messages_per_case(spark, sf):
    return X.interactions(spark, sf).groupBy("nro_caso").agg(F.count("*").alias("mensajes"))


@query
def a2_conditional_counts(spark, sf):
    return facts(spark, sf).select("nro_caso", "total", "cliente", "bot", "humano", "multimedia")


@query
def a3_first_last_times(spark, sf):
    return facts(spark, sf).select("nro_caso", "t0", "primera_fecha", "ultima_fecha")


@query
def a4_first_message_labels(spark, sf):
    return facts(spark, sf).select("nro_caso", "primer_canal", "primera_campania")


@query
def a5_mean_gap(spark, sf):
    return K.judged_cases(X.interactions(spark, sf)).select("nro_caso", "pausa_media")


@query
def a6_copies_removed(spark, sf):
    return facts(spark, sf).select("nro_caso", "duplicados", "dup_sustantivo")


@query
def a7_any_flags(spark, sf):
    return facts(spark, sf).select("nro_caso", "hubo_llamada", "venta", "colaborador")


@query
def a8_client_texts(spark, sf):
    return facts(spark, sf).select("nro_caso", "textos", "texto_unico")


@query
def a9_case_labels(spark, sf):
    return facts(spark, sf).select("nro_caso", "fecha_caso", "canal_caso", "campania_caso")


@query
def a10_run_summary(spark, sf):
    return A.run_summary(K.classify_cases(X.interactions(spark, sf)))


@query
def a11_audit_summary(spark, sf):
    return A.audit_summary(one_audit(spark, sf))


@query
def a12_general_summary(spark, sf):
    return A.general_summary(master(spark, sf))


@query
def a13_period_matrix(spark, sf):
    return A.period_matrix(master(spark, sf), names=A.SECTION_NAMES)


@query
def a14_appearances_per_period(spark, sf):
    return A.appearances_per_period(master(spark, sf))


# --- windows -----------------------------------------------------------------


@query
def w1_exact_copies(spark, sf):
    return G.drop_exact_copies(X.interactions(spark, sf))


@query
def w2_longest_gap(spark, sf):
    return G.longest_gaps(X.interactions(spark, sf))


@query
def w3_first_client_time(spark, sf):
    return facts(spark, sf).where(F.col("total") > 0).select("nro_caso", "t0")


@query
def w4_latest_report(spark, sf):
    return U.latest_per_case(period_metrics(spark, sf), U.REPORTS).select(
        "nro_caso", "total_mensajes", "fecha_calculo", *PERIOD_COLS
    )


@query
def w5_first_cases(spark, sf):
    return U.latest_per_case(period_cases(spark, sf), U.CASE_TABLES)


@query
def w6_priority_section(spark, sf):
    return B.not_attended_cases(master(spark, sf))


# --- sorts and limits --------------------------------------------------------


@query
def o1_messages_in_order(spark, sf):
    return X.interactions(spark, sf).orderBy("nro_caso", "fecha_creacion", "id")


@query
def o2_final_order(spark, sf):
    return U.unify(period_metrics(spark, sf), U.REPORTS)


@query
def o3_capped_listing(spark, sf):
    return A.all_cases_listing(master(spark, sf))


@query
def o4_section_listings(spark, sf):
    return A.section_listings(master(spark, sf))


# --- set operations ----------------------------------------------------------


@query
def u1_union_by_name(spark, sf):
    both = period_metrics(spark, sf).select(
        "periodo_desde", "nro_caso", "total_mensajes", "agente", "icc_score"
    )
    first = f"periodo_desde = {C.date(PERIODS[0][0])}"
    old = both.where(first).drop("agente", "periodo_desde")
    new = both.where(f"NOT {first}").drop("icc_score", "periodo_desde")
    return U.union_reports([new, old])


@query
def u2_attended_union(spark, sf):
    table = B.cases_from_results(all_results(spark, sf))
    return table.groupBy("atendido", "categoria_no_atendida").agg(F.count("*").alias("casos"))


# --- whole jobs --------------------------------------------------------------


@query
def c1_classify_cases(spark, sf):
    return K.classify_cases(X.interactions(spark, sf)).withColumn(
        "categorias", F.array_join("categorias", ",")
    )


@query
def case_outcomes(spark, sf):
    return K.case_outcomes(X.interactions(spark, sf))


@query
def c2_case_metrics(spark, sf):
    return K.case_metrics(X.interactions(spark, sf), CALC)


@query
def c3_audit_rows(spark, sf):
    return one_audit(spark, sf)


@query
def c4_build_report(spark, sf):
    return B.build_report(K.case_metrics(X.interactions(spark, sf), CALC))


@query
def c5_build_cases(spark, sf):
    return B.cases_from_results(all_results(spark, sf))


@query
def c6_unify_reports(spark, sf):
    return U.unify(B.build_report(period_metrics(spark, sf)), U.REPORTS)


@query
def c6_unify_cases(spark, sf):
    return U.unify(period_cases(spark, sf), U.CASE_TABLES)


@query
def c6_unify_range_no_dedup(spark, sf):
    return U.unify(
        period_cases(spark, sf), U.CASE_TABLES, dt.date(2024, 1, 1), dt.date(2024, 1, 4), dedup=False
    )


@query
def c6_incremental_unify(spark, sf):
    """A unified table after one of three periods, first stored with the rows of another,
    was replaced, and only it was read again."""
    base = scratch_dir(spark, "c6")
    results, _ = stored_results(spark, sf, "c6_resultados")
    report = B.build_report(kept(results))
    for period, rows in zip(PERIODS, (PERIODS[0], PERIODS[2], PERIODS[2])):
        tables.write_period(of_period(report, rows), f"{base}/reporte", *period, REPORT)
    P.refresh_unified(spark, base, csv=False)
    tables.write_period(of_period(report, SECOND), f"{base}/reporte", *SECOND, REPORT)
    return P.refresh_unified(spark, base, changed=[SECOND], csv=False)


@query
def c7_run_period(spark, sf):
    return P.run_period(
        spark, X.source_messages(spark, sf), scratch_dir(spark, "c7"), *SECOND, calc_ts=CALC
    )


def _overview(spark, sf, sheet: str) -> DataFrame:
    base = _stored_master(spark, sf, "c8")
    periods = audits.list_audit_periods(spark, base)
    return A.audit_overview(audits.read_master(spark, base), periods)[sheet]


@query
def c8_overview_summary(spark, sf):
    return _overview(spark, sf, "Resumen")


@query
def c8_overview_matrix(spark, sf):
    return _overview(spark, sf, "Por periodo")


@query
def c8_overview_listing(spark, sf):
    return _overview(spark, sf, "Todos")


@query
def c8_overview_sections(spark, sf):
    return _overview(spark, sf, "Por seccion")


@query
def c8_period_listing(spark, sf):
    return A.period_overview(one_audit(spark, sf))["Todos"]
