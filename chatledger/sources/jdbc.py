"""Message source over JDBC.

The reader gets ranges of the monotonic ``id`` so that executors fetch in
parallel; Spark pushes the projection, the date filter and the count down to the
database. Spark's task retry replaces a retry loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger.functions.calendar import in_date_range
from chatledger.operators.cleaning import source_projection

FETCH_ROWS = 5000


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    id_range: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, str]:
    """Reader options. ``id_range`` (lowest, highest id) turns on the parallel read."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    if id_range is not None:
        low, high = id_range
        if low > high:
            raise ValueError("empty id range")
        options |= {
            "partitionColumn": "id",
            "lowerBound": str(low),
            "upperBound": str(high + 1),
            "numPartitions": str(partitions),
        }
    return options


def probe(spark: SparkSession, options: dict[str, str]) -> None:
    """One constant row through the connection; raises if that cannot be had."""
    query = {k: v for k, v in options.items() if k != "dbtable"} | {"query": "SELECT 1 AS ok"}
    spark.read.format("jdbc").options(**query).load().first()


def range_rows(spark: SparkSession, options: dict[str, str], since: dt.date, until: dt.date) -> DataFrame:
    """Rows of the date range with the eight source columns."""
    rows = spark.read.format("jdbc").options(**options).load()
    return source_projection(rows).where(in_date_range("fecha_creacion", since, until))


def id_bounds(spark: SparkSession, options: dict[str, str], since: dt.date, until: dt.date) -> DataFrame:
    """Lowest and highest id and the number of rows (S2), computed by the database."""
    return range_rows(spark, options, since, until).agg(
        F.min("id").alias("desde"), F.max("id").alias("hasta"), F.count("*").alias("total")
    )


def read_messages(
    spark: SparkSession,
    since: dt.date,
    until: dt.date,
    *,
    rows_per_partition: int = 1_000_000,
    **connection,
) -> DataFrame:
    """S1 with the partition bounds taken from the database first."""
    bounds = id_bounds(spark, jdbc_options(**connection), since, until).first()
    if not bounds["total"]:
        return range_rows(spark, jdbc_options(**connection), since, until)
    partitions = bounds["total"] // rows_per_partition + 1
    options = jdbc_options(
        **connection, id_range=(bounds["desde"], bounds["hasta"]), partitions=partitions
    )
    return range_rows(spark, options, since, until)
