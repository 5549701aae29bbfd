"""Period tables on a file system.

A table is a directory partitioned by ``periodo_desde`` / ``periodo_hasta``. A period
is replaced by dynamic partition overwrite: the new files are staged, and the old ones
go when the job commits, so a failed job leaves the period as it was. That keeps old
rows when there are no new ones, so an empty result is then written as an empty leaf.
Readers declare the schema, so empty periods read well.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatledger.functions.calendar import period_from_name
from chatledger.sources import versions

PERIOD_FIELDS = [
    T.StructField("periodo_desde", T.DateType()),
    T.StructField("periodo_hasta", T.DateType()),
]


def period_path(base: str, since: dt.date, until: dt.date) -> str:
    return f"{base}/periodo_desde={since.isoformat()}/periodo_hasta={until.isoformat()}"


def replace_partition(table: DataFrame, base: str, values: dict[str, object], path: str) -> int:
    """Replace one partition, ``path``, of the table at ``base``. Returns the number of rows,
    which are counted on the way."""
    written = Observation()
    rows = table.observe(written, F.count(F.lit(1)).alias("filas"))
    (
        rows.withColumns({name: F.lit(value) for name, value in values.items()})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*values)
        .parquet(base)
    )
    if not written.get["filas"]:
        table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(path)
    return written.get["filas"]


def write_period(
    table: DataFrame, base: str, since: dt.date, until: dt.date, schema: T.StructType | None = None
) -> int:
    """K1, K3, K5, K6: replace one period, columns in the order of ``schema``; the number of rows."""
    path = period_path(base, since, until)
    if schema is not None:
        table = table.select(*[F.col(f"`{n}`") for n in schema.names])
    return replace_partition(table, base, {"periodo_desde": since, "periodo_hasta": until}, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` can be read; with a schema given, resolving a reader runs no job."""
    try:
        spark.read.schema("x int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


#: Number of a row in a sorted table: partition of the sort, then place in it.
ORDER_COLUMN = "orden"


def write_sorted(table: DataFrame, base: str) -> str:
    """K7: a sorted table as the current version of ``base``. Files read back keep no order, so
    rows keep the number of their place; no later pass has to sort them again."""
    return versions.write(table.withColumn(ORDER_COLUMN, F.monotonically_increasing_id()), base)


def read_sorted(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The current version of what ``write_sorted`` wrote, with the order column."""
    return versions.read(spark, base, T.StructType([*schema.fields, T.StructField(ORDER_COLUMN, T.LongType())]), versions.WHOLE)


def read_period(
    spark: SparkSession, base: str, since: dt.date, until: dt.date, schema: T.StructType
) -> DataFrame:
    """One period; an error when it was never written."""
    path = period_path(base, since, until)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"period not written yet: {path}") from error
        raise


def read_periods(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """All periods with their period columns. Filter on those (see ``unify``) to
    prune directories. Without a schema, the union of all columns found is read."""
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(base)
    return spark.read.schema(T.StructType(schema.fields + PERIOD_FIELDS)).parquet(base)


def list_periods(spark: SparkSession, base: str) -> DataFrame:
    """The periods present, empty ones included. Only file names are read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
    )
    return files.select(
        F.col("periodo_desde").cast("date"), F.col("periodo_hasta").cast("date")
    ).distinct()


def read_named_files(spark: SparkSession, directory: str, kind: str, schema: T.StructType) -> DataFrame:
    """S7 + F15 for single files named ``<kind>_<from>_<to>.parquet``. Unified results
    are left out by their name; other files without two dates in it are kept, with null
    periods, so that only a selection by range or period leaves them out."""
    since, until = period_from_name("_metadata.file_name")
    files = (
        spark.read.schema(schema).option("pathGlobFilter", f"{kind}_*.parquet").parquet(directory)
    )
    return files.selectExpr(
        "*", f"{since} AS periodo_desde", f"{until} AS periodo_hasta"
    ).where(f"NOT startswith(_metadata.file_name, '{kind}_unificado')")


def read_named_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Messages of raw files without ``id``: the row position stands in for it, over
    all files in the order of their paths. The files are counted first (from their
    footers' row counts); the running total has one row per file."""
    fields = T.StructType([f for f in schema.fields if f.name != "id"])
    rows = spark.read.schema(fields).parquet(path)
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = placed.groupBy("__file").agg(F.count("*").alias("__rows"))
    before = "coalesce(sum(__rows) OVER (ORDER BY __file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    starts = sizes.selectExpr("__file", f"{before} AS __start")
    return placed.join(starts, "__file").selectExpr("__start + __row AS id", *[f"`{n}`" for n in fields.names])


def _csv_text(name: str, kind: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return F.initcap(col.cast("string"))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        text = col.cast("string")
        # a fraction always has six digits
        return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)
    return col


def write_csv(table: DataFrame, path: str) -> str:
    """CSV with header; null and '' are both an empty field, quotes are doubled. A table with
    an order column is written without a shuffle, one folder ``rango=`` for each range of its sort:
    folders and the files in them follow each other in order."""
    fields = [f for f in table.schema.fields if f.name != ORDER_COLUMN]
    texts = [_csv_text(f.name, f.dataType).alias(f.name) for f in fields]
    rows, ranges = table.select(*texts), []
    if len(fields) < len(table.schema.fields):
        place = F.lpad(F.shiftright(ORDER_COLUMN, 33).cast("string"), 8, "0")
        rows = table.select(*texts, F.col(ORDER_COLUMN), place.alias("rango")).sortWithinPartitions("rango", ORDER_COLUMN)
        rows, ranges = rows.drop(ORDER_COLUMN), ["rango"]
    (
        rows.write.partitionBy(*ranges)
        .mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads what ``write_csv`` wrote."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
        .select(*schema.names)
    )


def one_line_texts(messages: DataFrame) -> DataFrame:
    """K2: line breaks inside message texts become blanks."""
    return messages.withColumn("contenido", F.translate("contenido", "\r\n", "  "))
