"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up, then ``$BENCH_RUNS`` times; the median counts. A run
builds the plan, reads the source table and computes every result row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

import spark_queries as Q

HEADLINE = {
    "case_outcomes": Q.case_outcomes,
    "case_metrics": Q.c2_case_metrics,
    "audit_rows": Q.c3_audit_rows,
    "build_report": Q.c4_build_report,
    "build_cases": Q.c5_build_cases,
    "unify_reports": Q.c6_unify_reports,
    "run_summary": Q.a10_run_summary,
    "audit_overview": Q.c8_overview_listing,
    "run_period": Q.c7_run_period,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in HEADLINE.items():
        times = []
        for _ in range(runs + 1):
            start = time.time()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "events": events,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
