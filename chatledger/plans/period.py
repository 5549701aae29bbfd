"""The batch jobs: one period from source to audit, reports, and unified tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger.operators import audit as A
from chatledger.operators import unify as U
from chatledger.operators.classify import case_results, metrics_from_results
from chatledger.operators.cleaning import clean_messages, reject_reason, rows_between
from chatledger.operators.report import build_cases, build_report
from chatledger.rules import DEFAULT_RULES, Rules
from chatledger.schemas import AUDIT, CASE_RESULTS, CASES, MESSAGES, METRICS, REPORT
from chatledger.sources import audits, tables, versions


#: Reasons that a row with a readable time can be rejected for.
REJECTED = ("sin_caso", "direccion_desconocida", "caso_ilegible")


class Folders:
    """Table locations under one base path."""

    def __init__(self, base: str):
        self.raw = f"{base}/raw"
        self.raw_csv = f"{base}/raw_csv"
        self.results = f"{base}/resultados"
        self.metrics = f"{base}/metricas"
        self.metrics_csv = f"{base}/metricas_csv"
        self.audit_json = f"{base}/auditoria_json"
        self.audit_csv = f"{base}/auditoria_csv"
        self.master = f"{base}/auditoria_general"
        self.reports = f"{base}/reporte"
        self.reports_csv = f"{base}/reporte_csv"
        self.cases = f"{base}/casos"
        self.cases_csv = f"{base}/casos_csv"

    def unified(self, kind: U.ReportKind) -> tuple[str, str]:
        base = self.reports.rsplit("/", 1)[0]
        return f"{base}/unificado/{kind.name}", f"{base}/unificado/{kind.name}_csv"


def resolve_period(
    day: dt.date | None = None, since: dt.date | None = None, until: dt.date | None = None
) -> U.Period:
    """One day, a range of days, or yesterday."""
    if day is not None:
        return day, day
    if since is None and until is None:
        yesterday = dt.date.today() - dt.timedelta(days=1)
        return yesterday, yesterday
    if since is None or until is None:
        raise ValueError("give both dates of the range")
    if since > until:
        raise ValueError("the first date must not be after the last")
    return since, until


def period_key(since: dt.date, until: dt.date) -> str:
    return f"{since.isoformat()}_{until.isoformat()}"


def extract_period(
    spark: SparkSession, rows: DataFrame, base: str, since: dt.date, until: dt.date, csv: bool = True
) -> DataFrame:
    """Source rows of the period, cleaned, as raw Parquet and, if wanted, CSV; returns
    the number of source rows, of rows kept, and of rows rejected by reason. One pass over the
    source counts them while it writes. Rows without a readable time are in no period."""
    to = Folders(base)
    source = rows_between(rows, since, until)
    reason, seen = reject_reason(source), Observation()
    counts = [F.expr(f"count_if({reason} <=> '{r}') AS {r}") for r in REJECTED]
    messages = clean_messages(source.observe(seen, F.count(F.lit(1)).alias("total"), *counts))
    kept = tables.write_period(messages, to.raw, since, until, MESSAGES)
    if csv:
        raw = tables.read_period(spark, to.raw, since, until, MESSAGES)
        lines = tables.one_line_texts(raw).drop("id")
        tables.write_csv(lines, tables.period_path(to.raw_csv, since, until))
    found = [("estimado_origen", seen.get["total"]), ("total_filas", kept)]
    found += [(f"rechazados_{r}", seen.get[r]) for r in REJECTED]
    return spark.createDataFrame(found, "concepto string, valor bigint")


def compute_period(
    spark: SparkSession,
    base: str,
    since: dt.date,
    until: dt.date,
    calc_ts: dt.datetime | str | Column | None = None,
    rules: Rules = DEFAULT_RULES,
    csv: bool = True,
) -> DataFrame:
    """Metrics and audit of a period from its raw messages; returns the summary.

    The cases are analysed once and stored; everything else reads that table, so a
    lost executor costs tasks, not the whole analysis."""
    to = Folders(base)
    raw = tables.read_period(spark, to.raw, since, until, MESSAGES)
    tables.write_period(case_results(raw, calc_ts, rules), to.results, since, until, CASE_RESULTS)
    results = tables.read_period(spark, to.results, since, until, CASE_RESULTS)

    tables.write_period(metrics_from_results(results), to.metrics, since, until, METRICS)
    if csv:
        metrics = tables.read_period(spark, to.metrics, since, until, METRICS)
        tables.write_csv(metrics, tables.period_path(to.metrics_csv, since, until))

    audit = A.audit_rows(results)
    audits.upsert_period(audit, to.master, period_key(since, until))
    stored = audits.read_period_audit(spark, to.master, period_key(since, until))
    audits.write_audit(
        stored,
        tables.period_path(to.audit_json, since, until),
        tables.period_path(to.audit_csv, since, until) if csv else None,
    )
    return A.run_summary(results)


def run_period(
    spark: SparkSession,
    rows: DataFrame | None,
    base: str,
    since: dt.date,
    until: dt.date,
    *,
    only_extract: bool = False,
    only_metrics: bool = False,
    calc_ts: dt.datetime | str | Column | None = None,
    rules: Rules = DEFAULT_RULES,
    csv: bool = True,
) -> DataFrame:
    """Extract, then compute. Running a period again replaces it. ``csv=False``
    leaves out the CSV copies."""
    if since > until:
        raise ValueError("the first date must not be after the last")
    if only_extract and only_metrics:
        raise ValueError("only_extract and only_metrics exclude each other")
    summaries = []
    if not only_metrics:
        if rows is None:
            raise ValueError("source rows are needed to extract")
        summaries.append(extract_period(spark, rows, base, since, until, csv))
    if not only_extract:
        summaries.append(compute_period(spark, base, since, until, calc_ts, rules, csv))
    return U.union_reports(summaries)


def report_period(
    spark: SparkSession, base: str, since: dt.date, until: dt.date, csv: bool = True
) -> DataFrame:
    """The report and the cases table of a period (K5, K6); returns the report.
    Without an audit for the period the cases table has attended cases only. The audit
    comes from the master table, of which only the sections needed are read."""
    to = Folders(base)
    metrics = tables.read_period(spark, to.metrics, since, until, METRICS)
    tables.write_period(build_report(metrics), to.reports, since, until, REPORT)
    report = tables.read_period(spark, to.reports, since, until, REPORT)
    if csv:
        tables.write_csv(report, tables.period_path(to.reports_csv, since, until))

    audit = audits.read_period_audit(spark, to.master, period_key(since, until))
    tables.write_period(build_cases(metrics, audit), to.cases, since, until, CASES)
    if csv:
        cases = tables.read_period(spark, to.cases, since, until, CASES)
        tables.write_csv(cases, tables.period_path(to.cases_csv, since, until))
    return report


def unify_tables(
    spark: SparkSession,
    base: str,
    kind: U.ReportKind = U.REPORTS,
    since: dt.date | None = None,
    until: dt.date | None = None,
    periods: list[U.Period] | None = None,
    dedup: bool = True,
    csv: bool = True,
) -> DataFrame:
    """C6 with its sink (K7): the unified table, stored sorted as Parquet and, if wanted, as
    CSV, which a narrow pass makes. A selection that holds no rows is refused; then, and if a job
    fails, the stored table stays as it is."""
    to = Folders(base)
    source, schema = (
        (to.reports, REPORT) if kind.name == U.REPORTS.name else (to.cases, CASES)
    )
    if periods is not None:
        for period in periods:
            tables.read_period(spark, source, *period, schema)  # raises if missing
    available = tables.read_periods(spark, source, schema)
    if U.select_periods(available, since, until, periods).isEmpty():
        raise ValueError("no rows in the selected periods; the unified table was left as it is")
    table = U.unify(available, kind, since, until, periods, dedup)
    return _write_unified(table, to, kind, schema, csv)


def _write_unified(table: DataFrame, to: Folders, kind: U.ReportKind, schema: T.StructType, csv: bool) -> DataFrame:
    path, csv_path = to.unified(kind)
    tables.write_sorted(table, path)
    stored = tables.read_sorted(table.sparkSession, path, schema)
    if csv:
        tables.write_csv(stored, csv_path)
    return stored.drop(tables.ORDER_COLUMN)


def refresh_unified(
    spark: SparkSession,
    base: str,
    kind: U.ReportKind = U.REPORTS,
    changed: Sequence[U.Period] | None = None,
    csv: bool = True,
) -> DataFrame:
    """C6 for all periods, without reading those that are not ``changed`` (written anew, new, or
    removed) since the last refresh. The best two rows of each case are kept for that, as a
    versioned table. Only cases whose kept rows are all of changed periods, while more periods have
    them, are looked up in the other periods. Without ``changed``, or the first time, all is read."""
    to = Folders(base)
    source, schema = (to.reports, REPORT) if kind.name == U.REPORTS.name else (to.cases, CASES)
    path = f"{to.unified(kind)[0]}_candidatos"
    available = tables.read_periods(spark, source, schema)
    if changed is not None and versions.present(spark, path):
        columns = T.StructType([*available.schema.fields, T.StructField("lugar", T.IntegerType()), T.StructField("resto", T.BooleanType())])
        kept = versions.read(spark, path, columns, versions.WHOLE)
        merged = U.merge_candidates(kept, available.where(U.one_of(changed)), kind, changed)
        # written, as it is read for what stays and for what is lost
        work = f"{path}_mezcla"
        versions.write(merged, work)
        merged = versions.read(spark, work, T.StructType([*columns.fields, T.StructField("perdido", T.BooleanType())]), versions.WHOLE)
        found, lost = merged.where("NOT perdido").drop("perdido"), merged.where("perdido").select("nro_caso")
        if not lost.isEmpty():
            found = found.unionByName(U.candidates(available.join(lost, "nro_caso", "left_semi"), kind))
    else:
        found = U.candidates(available, kind)
    best = spark.read.schema(found.schema).parquet(versions.write(found, path)).where("lugar = 1")
    return _write_unified(U.sort_unified(best, kind).select(*schema.names), to, kind, schema, csv)
