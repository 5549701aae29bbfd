"""Audit files: JSON and the general audit table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger.operators.audit import flat_audit
from chatledger.schemas import AUDIT, AUDIT_MASTER
from chatledger.sources import versions
from chatledger.sources.tables import write_csv

_CASE = "struct<nro_caso: bigint, fecha: string, campania: string, canal: string>"


def _parsed_cases(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """A case is an object, or in older files only its number."""
    case = F.from_json("caso", _CASE)
    parsed = rows.select("seccion", "caso", *extra, case.alias("c"))
    return parsed.select(
        F.coalesce("c.nro_caso", F.col("caso").try_cast("bigint")).alias("nro_caso"),
        F.coalesce("c.fecha", F.lit("")).alias("fecha"),
        "c.campania",
        "c.canal",
        "seccion",
        *extra,
    )


def write_audit(audit: DataFrame, json_path: str, csv_path: str | None = None) -> None:
    """K4: JSON, one line ``{"seccion": .., "caso": {..}}`` per case, and the flat CSV if
    it gets a path.

    Lines instead of one nested document: a section may hold any number of cases, and
    lines are written and read in parallel."""
    case = F.struct("nro_caso", "fecha", "campania", "canal")
    (
        audit.select("seccion", case.alias("caso"))
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .json(json_path)
    )
    if csv_path is not None:
        write_csv(flat_audit(audit), csv_path)


def read_audit(spark: SparkSession, json_path: str) -> DataFrame:
    """Audit lines back as a table."""
    return _parsed_cases(spark.read.schema("seccion string, caso string").json(json_path))


_COMMA_IN_KEY = "CAST(raise_error('a section or period with a comma in its name') AS string)"
# One JSON key up to its colon.
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_KEY = rf'"({_STRING})"\s*:\s*'


def _case_texts(spark: SparkSession, path: str, level: int) -> DataFrame:
    """The cases of nested documents, as text, with the keys of the ``level`` objects that
    enclose their list: (clave_1, .., clave_<level>, caso).

    A document is read in pieces that end at commas, so any task can begin anywhere in it. What
    a piece means depends on all pieces before: whether it begins inside a string, how deep,
    and under which keys. Each is a running value, taken within a file block and then over
    the blocks of the file, which are few. A case is its pieces from the first one at the
    depth of the list up to the next."""
    pieces = spark.read.option("lineSep", ",").text(path).select(
        F.translate("value", "\ufeff\r\n\t", "   ").alias("t"),
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("bloque"),
        F.monotonically_increasing_id().alias("n"),
    )
    block, rows = "PARTITION BY archivo, bloque ORDER BY n", "ROWS BETWEEN UNBOUNDED PRECEDING AND"

    def running(frame: DataFrame, sums: dict[str, str], lasts: Sequence[str] = ()) -> DataFrame:
        """For each sum its value before the piece, for each column its last value up to it."""
        inside = [f"coalesce(sum({v}) OVER ({block} {rows} 1 PRECEDING), 0L) AS {k}" for k, v in sums.items()]
        inside += [f"last({c}, true) OVER ({block} {rows} CURRENT ROW) AS {c}_" for c in lasts]
        whole = [f"sum({v}) AS {k}_b" for k, v in sums.items()] + [f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN n END) AS {c}_b" for c in lasts]
        blocks = frame.groupBy("archivo", "bloque").agg(*map(F.expr, whole))
        over = "OVER (PARTITION BY archivo ORDER BY bloque ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        carried = [f"coalesce(sum({k}_b) {over}, 0L) AS {k}_a" for k in sums] + [f"last({c}_b, true) {over} AS {c}_a" for c in lasts]
        both = frame.selectExpr("*", *inside).join(blocks.selectExpr("archivo", "bloque", *carried), ["archivo", "bloque"])
        values = {k: f"{k} + {k}_a" for k in sums} | {c: f"coalesce({c}_, {c}_a)" for c in lasts}
        kept = [c for c in frame.columns if c not in values]
        return both.selectExpr(*kept, *[f"{v} AS {k}" for k, v in values.items()])

    bare = r"regexp_replace(t, r'\\.', '__')"
    quotes = running(pieces.selectExpr("*", f"{bare} AS s", f"CAST(length({bare}) - length(replace({bare}, '\"', '')) AS bigint) AS q"), {"antes": "q"})
    # without what stands in strings
    shape = r"""regexp_replace(if(antes % 2 = 1, concat('"', s), s), r'"[^"]*("|$)', '')"""
    shaped = quotes.selectExpr("archivo", "bloque", "n", "t", "antes % 2 = 0 AS libre", f"{shape} AS f")
    count = "CAST(length(f) - length(translate(f, '{}', '')) AS bigint)".format
    shaped = shaped.selectExpr("*", f"{count('{[')} - {count('}]')} AS neto")
    depths = running(shaped, {"nivel": "neto"})
    # keys that open an object, the outer ones, and the one that opens the list
    opened = {
        f"clave_{i}": f"nullif(regexp_extract(t, r'{_KEY}{chr(92)}{mark}', 1), '')"
        for i, mark in [*((i, "{") for i in range(1, level)), (level, "[")]
    }
    marks = {f"clave_{i}": "contains(f, ':') AND f rlike r':\\s*\\{'" for i in range(1, level)} | {f"clave_{level}": "f rlike r':\\s*\\['"}
    named = depths.selectExpr(
        "*", *[f"CASE WHEN nivel <= {level} AND {marks[k]} THEN if(libre, {v}, {_COMMA_IN_KEY}) END AS {k}" for k, v in opened.items()]
    )
    # the text from the first item of a list on
    head = rf"regexp_replace(t, r'^[\s\]}}{{]*(?:{_KEY}\{{\s*)*{_KEY}\[\s*', '')"
    item = named.selectExpr(
        "*",
        f"CASE WHEN clave_{level} IS NOT NULL THEN {head} WHEN libre AND nivel = {level + 1} THEN t END AS inicio",
    ).selectExpr("*", r"CAST(ltrim(inicio) rlike r'^[^\]}]' AS int) AS empieza")
    item = running(item, {"anteriores": "coalesce(empieza, 0)"}, list(opened))
    inside = item.where(f"empieza = 1 OR nivel > {level + 1} OR NOT libre").selectExpr(
        "archivo", *opened, "anteriores + coalesce(empieza, 0) AS caso_n", "bloque", "n",
        "if(empieza = 1, inicio, t) AS parte", "coalesce(empieza, 0) AS empieza",
    )
    cases = inside.groupBy("archivo", "caso_n").agg(
        F.array_join(F.expr("transform(array_sort(collect_list(struct(bloque, n, parte))), x -> x.parte)"), ",").alias("texto"),
        *[F.expr(f"max(CASE WHEN empieza = 1 THEN {k} END) AS {k}") for k in opened],
    )
    # up to the end of the object or the number
    text = rf"""if(startswith(ltrim(texto), '{{'), regexp_extract(texto, r'^\s*(\{{[^"}}]*+(?:"{_STRING}"[^"}}]*+)*+\}})', 1),
        regexp_extract(texto, r'^\s*"?([^\s",\]}}]*)', 1))"""
    return cases.where("caso_n > 0").selectExpr(*opened, f"{text} AS caso")


def read_audit_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested documents, section -> list of cases, however written. A document is
    read by as many tasks as it has blocks."""
    return _parsed_cases(_case_texts(spark, path, 1).withColumnRenamed("clave_1", "seccion"))


def read_master_document(spark: SparkSession, path: str) -> DataFrame:
    """The nested general document, period -> section -> list of cases, in the same way."""
    texts = _case_texts(spark, path, 2).withColumnsRenamed({"clave_1": "periodo", "clave_2": "seccion"})
    return _parsed_cases(texts, ("periodo",))


def upsert_period(audit: DataFrame, base: str, key: str) -> str:
    """K8: the audit of a period replaces what the master had for it, once it is whole."""
    return versions.write(audit.select(*AUDIT.names), base, key)


def read_master(spark: SparkSession, base: str) -> DataFrame:
    """The general audit as a long table with ``periodo``, on which filters prune."""
    return versions.read(spark, base, AUDIT, column="periodo").select(*AUDIT_MASTER.names)


def read_period_audit(spark: SparkSession, base: str, key: str) -> DataFrame:
    """The audit of one period; without one, no rows."""
    try:
        return versions.read(spark, base, AUDIT, key)
    except FileNotFoundError:
        return spark.createDataFrame([], AUDIT)


def list_audit_periods(spark: SparkSession, base: str) -> DataFrame:
    """Period keys in the master, empty periods included."""
    return versions.keys(spark, base).select(F.col("clave").alias("periodo"))


def remove_period(spark: SparkSession, base: str, key: str) -> bool:
    """K9: the master no longer has the period; no file is touched and other periods are
    not read. False when the master has no such period."""
    return versions.remove(spark, base, key)
