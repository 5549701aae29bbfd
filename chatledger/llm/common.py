"""What the operators share: reading, stored intermediate tables, Arrow functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a ``local[...]`` session without
    that setting, as in tests, gets a folder of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later jobs start there, also
    after an executor is lost."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_text(function: Callable[[list], list], ddl: str) -> Callable[..., Column]:
    """An Arrow function over one column: ``function`` gets the values of a batch as a
    list and returns a list of rows of type ``ddl``. Marked as not deterministic so that
    Catalyst evaluates it once, not once for each use."""
    kind = to_arrow_type(T.DataType.fromDDL(ddl))

    def run(values: pa.Array) -> pa.Array:
        return pa.array(function(values.to_pylist()), kind)

    return F.arrow_udf(run, ddl).asNondeterministic()
