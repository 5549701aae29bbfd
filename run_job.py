"""The jobs from a shell:

    spark-submit run_job.py period --source PATH --base PATH [--day D | --since D --until D]
    spark-submit run_job.py period --jdbc-url URL --table NAME [--user U] --base PATH [dates]
    spark-submit run_job.py report --base PATH [--day D | --since D --until D]
    spark-submit run_job.py unify --base PATH [--kind casos] [--since D --until D | --periods P .. | --changed P ..] [--no-dedup]
    spark-submit run_job.py audit periods --base PATH
    spark-submit run_job.py audit overview --base PATH --out PATH
    spark-submit run_job.py audit remove|restore --base PATH --period P

``--source`` is a Parquet table of source messages; a database is read by date range, with the
password from ``JDBC_PASSWORD``. A period P is ``2024-01-01_2024-01-02``. Without dates,
``period`` and ``report`` take yesterday and ``unify`` takes all periods.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from chatledger.operators import audit as A
from chatledger.operators import unify as U
from chatledger.plans import period as P
from chatledger.sources import audits, jdbc, tables, versions

KINDS = {kind.name: kind for kind in (U.REPORTS, U.CASE_TABLES)}


def period(text: str) -> U.Period:
    since, until = text.split("_")
    return dt.date.fromisoformat(since), dt.date.fromisoformat(until)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description="Chat-case jobs")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in ("period", "report", "unify"):
        job = jobs.add_parser(name)
        job.add_argument("--base", required=True, help="folder of all tables")
        job.add_argument("--since", type=dt.date.fromisoformat)
        job.add_argument("--until", type=dt.date.fromisoformat)
        job.add_argument("--no-csv", dest="csv", action="store_false", help="leave out the CSV copies")
        if name != "unify":
            job.add_argument("--day", type=dt.date.fromisoformat)
    jobs.choices["period"].add_argument("--source", help="Parquet table of source messages")
    jobs.choices["period"].add_argument("--jdbc-url")
    jobs.choices["period"].add_argument("--table", help="of the database")
    jobs.choices["period"].add_argument("--user")
    jobs.choices["period"].add_argument("--driver", help="class of the JDBC driver")
    jobs.choices["period"].add_argument("--rows-per-task", type=int, default=1_000_000)
    jobs.choices["period"].add_argument("--only-extract", action="store_true")
    jobs.choices["period"].add_argument("--only-metrics", action="store_true")
    jobs.choices["unify"].add_argument("--kind", choices=sorted(KINDS), default=U.REPORTS.name)
    jobs.choices["unify"].add_argument("--no-dedup", dest="dedup", action="store_false")
    jobs.choices["unify"].add_argument("--periods", nargs="+", type=period)
    jobs.choices["unify"].add_argument("--changed", nargs="+", type=period)
    audit = jobs.add_parser("audit")
    audit.add_argument("what", choices=("periods", "overview", "remove", "restore"))
    audit.add_argument("--base", required=True, help="folder of all tables")
    audit.add_argument("--out", help="folder for the sheets of the overview, as CSV")
    audit.add_argument("--period", type=period)
    return top


def source_rows(spark: SparkSession, given: argparse.Namespace, dates: U.Period) -> DataFrame:
    if given.source:
        return spark.read.parquet(given.source)
    return jdbc.read_messages(
        spark, *dates, url=given.jdbc_url, table=given.table, user=given.user, driver=given.driver,
        password=os.environ.get("JDBC_PASSWORD"), rows_per_partition=given.rows_per_task,
    )


def audit_job(spark: SparkSession, given: argparse.Namespace) -> str | None:
    """Runs it; what is wrong, if anything."""
    master = P.Folders(given.base).master
    if given.what == "periods":
        for row in audits.list_audit_periods(spark, master).orderBy("periodo").collect():  # one a period
            print(row.periodo)
    elif given.what == "overview":
        sheets = A.audit_overview(audits.read_master(spark, master), audits.list_audit_periods(spark, master))
        for name, sheet in sheets.items():
            tables.write_csv(sheet, f"{given.out}/{name.lower().replace(' ', '_')}")
    else:
        change = audits.remove_period if given.what == "remove" else versions.restore
        if not change(spark, master, P.period_key(*given.period)):
            return "the audit has no such period" if given.what == "remove" else "this period was not removed"
    return None


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    top = parser()
    given = top.parse_args(arguments)
    try:
        if given.job == "audit":
            if given.what in ("remove", "restore") and not given.period or given.what == "overview" and not given.out:
                raise ValueError("--period or --out is missing")
        elif given.job == "unify":
            if (given.since is None) != (given.until is None):
                raise ValueError("give both dates of the range")
            if given.changed and (given.since or given.periods or not given.dedup):
                raise ValueError("--changed refreshes the unified table of all periods, one row per case")
        else:
            dates = P.resolve_period(given.day, given.since, given.until)
        if given.job == "period" and not given.only_metrics:
            if bool(given.source) == bool(given.jdbc_url) or given.jdbc_url and not given.table:
                raise ValueError("give --source, or --jdbc-url and --table, to extract")
    except ValueError as error:
        top.error(str(error))
    spark = spark or SparkSession.builder.appName(f"chatledger {given.job}").getOrCreate()
    if given.job == "period":
        rows = None if given.only_metrics else source_rows(spark, given, dates)
        summary = P.run_period(
            spark, rows, given.base, *dates,
            only_extract=given.only_extract, only_metrics=given.only_metrics, csv=given.csv,
        )
        summary.show(50, truncate=False)
    elif given.job == "report":
        P.report_period(spark, given.base, *dates, csv=given.csv)
    elif given.job == "audit":
        if wrong := audit_job(spark, given):
            top.error(wrong)
    elif given.changed:
        P.refresh_unified(spark, given.base, KINDS[given.kind], given.changed, given.csv)
    else:
        P.unify_tables(
            spark, given.base, KINDS[given.kind], given.since, given.until, given.periods, given.dedup, given.csv
        )


if __name__ == "__main__":
    main()
