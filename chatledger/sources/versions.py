"""Tables whose current content a pointer names (K7, K8, K9).

``<base>/datos/clave=<key>/version=<0|1>`` holds the last two contents of a key, and
``<base>/puntero`` one row per change. A change writes the place that is not current and
then adds its row, which is one file and so is there or not: a job that fails, or is still
writing, leaves readers what they had. Removing a key only adds a row, and can be undone by
``restore`` until the key is written again. One writer at a time; a reader that stays open over two
changes of a key loses its files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

WHOLE = "todo"  # the only key of a table without parts
_POINTER = "numero bigint, clave string, vigente boolean"


def _pointer(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(_POINTER).parquet(f"{base}/puntero")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def keys(spark: SparkSession, base: str) -> DataFrame:
    """(clave, numero): the keys present and the number of their last change."""
    pointer = _pointer(spark, base)
    if pointer is None:
        return spark.createDataFrame([], "clave string, numero bigint")
    last = pointer.groupBy("clave").agg({"numero": "max"}).withColumnRenamed("max(numero)", "numero")
    return pointer.join(last, ["clave", "numero"]).where("vigente").select("clave", "numero")


def _last(spark: SparkSession, base: str, key: str) -> tuple[int, bool]:
    """Number of the last change of a key, 0 for none, and whether the key is there."""
    pointer = _pointer(spark, base)
    rows = pointer.where(pointer.clave == key).orderBy("numero", ascending=False).head(1) if pointer is not None else []
    return (rows[0].numero, rows[0].vigente) if rows else (0, False)


def present(spark: SparkSession, base: str, key: str = WHOLE) -> bool:
    return _last(spark, base, key)[1]


def _point(spark: SparkSession, base: str, key: str, number: int, there: bool) -> None:
    spark.createDataFrame([(number, key, there)], _POINTER).coalesce(1).write.mode("append").parquet(f"{base}/puntero")


def _place(base: str, key: str, number: int) -> str:
    return f"{base}/datos/clave={key}/version={number % 2}"


def write(table: DataFrame, base: str, key: str = WHOLE) -> str:
    """Make ``table`` the content of the key; returns where it lies."""
    spark = table.sparkSession
    number, there = _last(spark, base, key)
    number += 1 if there or not number else 2  # never where the last content lies
    table.write.mode("overwrite").parquet(_place(base, key, number))
    _point(spark, base, key, number, True)
    return _place(base, key, number)


def remove(spark: SparkSession, base: str, key: str = WHOLE) -> bool:
    """Whether the key was there."""
    number, there = _last(spark, base, key)
    if there:
        _point(spark, base, key, number + 1, False)
    return there


def restore(spark: SparkSession, base: str, key: str = WHOLE) -> bool:
    """Undo the removal of a key; whether it was removed."""
    number, there = _last(spark, base, key)
    if number and not there:
        _point(spark, base, key, number + 1, True)  # two changes on: the same place
    return bool(number) and not there


def read(spark: SparkSession, base: str, schema: T.StructType, key: str | None = None, column: str = "clave") -> DataFrame:
    """The current content of one key, or of all with the key as last column, on which
    filters prune. An error if the one key, or the whole table, was never written."""
    if key is not None:
        number, there = _last(spark, base, key)
        if not there:
            raise FileNotFoundError(f"{key} is not in {base}")
        return spark.read.schema(schema).parquet(_place(base, key, number))
    if _pointer(spark, base) is None:
        raise FileNotFoundError(f"nothing written yet: {base}")
    places = [_place(base, row.clave, row.numero) for row in keys(spark, base).collect()]  # one a key
    full = T.StructType([*schema.fields, T.StructField("clave", T.StringType()), T.StructField("version", T.IntegerType())])
    if not places:
        return spark.createDataFrame([], full).drop("version").withColumnRenamed("clave", column)
    rows = spark.read.schema(full).option("basePath", f"{base}/datos").parquet(*places)
    return rows.drop("version").withColumnRenamed("clave", column)
