"""Compare registered queries with their SQL twins: columns, rows, values, types.

``python tests/compare.py [sf] [name ...]`` checks all or the named queries.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8, zone: str = "UTC") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chatledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", zone)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def difference(frame, con, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} <> {sorted(names)}"
    for field, kind in frame.dtypes:
        if _KINDS.get(kind, kind) != kinds[field]:
            return f"type of {field}: {kind} <> {kinds[field]}"
    order = sorted(names)
    theirs = Counter(
        tuple(dict(zip(names, row))[c] for c in order) for row in result.fetchall()
    )
    ours = Counter(tuple(row[c] for c in order) for row in frame.collect())
    if ours != theirs:
        more, less = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} <> {sum(theirs.values())} rows; {order}; only ours "
            f"{list(more)[:2]}; only theirs {list(less)[:2]}"
        )
    return None


def main(sf: str = "0.01", *chosen: str) -> int:
    import __spark_entry__ as entry

    spark = session()
    sf_dir = f"/root/testdata/sf{sf}"
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            problem = difference(frame, con, sql[name]) if name in sql else f"no SQL, {frame.count()} rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
