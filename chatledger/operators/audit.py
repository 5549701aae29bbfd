"""Audit of left-out and tagged cases.

The audit is a long table, one row per case and section; the general audit is the
same with a ``periodo`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger import rules as R
from chatledger.functions.calendar import minute_text, period_label
from chatledger.functions.text import quoted

SECTION_NAMES = tuple(R.SECTIONS.values())
TOTAL = "TOTAL"
UNKNOWN_ORDER = len(SECTION_NAMES) + 1
PERIOD_TOTAL_TEXT = "Apariciones en categorías (un caso puede estar en varias)."
GENERAL_TOTAL_TEXT = "Apariciones acumuladas en todos los periodos."


def sections(spark: SparkSession) -> DataFrame:
    """The 13 sections: category, section name, position, description."""
    entries = ", ".join(
        f"struct({quoted(category)} AS categoria, {quoted(section)} AS seccion,"
        f" {position} AS orden, {quoted(R.DESCRIPTIONS[section])} AS descripcion)"
        for position, (category, section) in enumerate(R.SECTIONS.items(), start=1)
    )
    return spark.range(1).selectExpr(f"inline(array({entries}))")


def audit_rows(cases: DataFrame) -> DataFrame:
    """C3 + J1: one row per case and section. Categories without a section drop out.
    The broadcast side is the fixed list of 13 sections."""
    extra = [c for c in ("periodo",) if c in cases.columns]
    tagged = cases.selectExpr(
        "nro_caso",
        f"{minute_text('fecha_caso')} AS fecha",
        "campania_caso AS campania",
        "canal_caso AS canal",
        *extra,
        "explode(categorias) AS categoria",
    )
    names = F.broadcast(sections(cases.sparkSession).select("categoria", "seccion"))
    return tagged.join(names, "categoria").select(
        "nro_caso", "fecha", "campania", "canal", "seccion", *extra
    )


def flat_audit(audit: DataFrame) -> DataFrame:
    """The three columns of the flat audit file."""
    return audit.select("nro_caso", "fecha", F.col("seccion").alias("categoria"))


def run_summary(cases: DataFrame) -> DataFrame:
    """A10: metrics computed, cases discarded, copies removed and the size of every
    section, zeros included. One global aggregate, nothing is exploded."""
    counts = {
        "metricas_calculadas": "count_if(NOT descartado)",
        "casos_descartados": "count_if(descartado)",
        "registros_duplicados_eliminados": "coalesce(sum(duplicados_eliminados), 0L)",
    } | {
        section: f"count_if(array_contains(categorias, {quoted(category)}))"
        for category, section in R.SECTIONS.items()
    }
    wide = cases.agg(*[F.expr(f"{sql} AS {name}") for name, sql in counts.items()])
    return wide.unpivot([], list(counts), "concepto", "valor")


def with_section_order(audit: DataFrame) -> DataFrame:
    """Position and description of each section; unknown ones come after the
    known ones with an empty description."""
    names = F.broadcast(
        sections(audit.sparkSession).select("seccion", "orden", "descripcion")
    )
    joined = audit.join(names, "seccion", "left")
    return joined.selectExpr(
        *audit.columns,
        f"coalesce(orden, {UNKNOWN_ORDER}) AS orden",
        "coalesce(descripcion, '') AS descripcion",
    )


def audit_summary(audit: DataFrame, total_text: str = PERIOD_TOTAL_TEXT) -> DataFrame:
    """Number of appearances per section, zeros included, and the total.

    The appearances are counted first; what follows works on one row per section."""
    known = sections(audit.sparkSession).select("seccion", "orden", "descripcion")
    counted = (
        audit.groupBy("seccion")
        .agg(F.count("*").alias("casos"))
        .join(F.broadcast(known), "seccion", "left")
        .select("seccion", "casos", "orden", "descripcion")
    )
    # every section once with zero, so that empty ones are listed
    blank = known.selectExpr("seccion", "0L AS casos", "orden", "descripcion")
    line = (
        f"struct(coalesce(orden, {UNKNOWN_ORDER}) AS orden, seccion AS categoria,"
        " coalesce(descripcion, '') AS descripcion) AS linea"
    )
    total = (
        f"struct({UNKNOWN_ORDER + 1} AS orden, {quoted(TOTAL)} AS categoria,"
        f" {quoted(total_text)} AS descripcion)"
    )
    return (
        counted.unionByName(blank)
        .selectExpr(line, "casos")
        .rollup("linea")
        .agg(F.sum("casos").alias("casos"), F.grouping("linea").alias("g"))
        .selectExpr(f"CASE WHEN g = 1 THEN {total} ELSE linea END AS linea", "casos")
        .select("linea.orden", "linea.categoria", "casos", "linea.descripcion")
    )


def general_summary(master: DataFrame) -> DataFrame:
    """A12."""
    return audit_summary(master, GENERAL_TOTAL_TEXT)


def section_names(master: DataFrame, most: int = 1000) -> tuple[str, ...]:
    """The standard sections and any others of ``master``, by name. One aggregate; more
    than ``most`` others are refused, as they cannot all be columns."""
    known = ", ".join(quoted(name) for name in SECTION_NAMES)
    others = master.where(f"seccion NOT IN ({known})").select("seccion").distinct()
    found = sorted(row.seccion for row in others.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"over {most} other sections; count them with appearances_per_section")
    return (*SECTION_NAMES, *found)


def appearances_per_section(master: DataFrame) -> DataFrame:
    """A13 in long form, for any number of sections: one row per period and section."""
    return master.groupBy("periodo", "seccion").agg(F.count("*").alias("casos"))


def period_matrix(
    master: DataFrame,
    periods: DataFrame | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Appearances per period and section with a row total.

    The sections are the columns: the standard ones and those found in ``master``, which
    costs one aggregate unless ``names`` gives them. Rows of sections not in ``names``
    count in the total only. ``periods`` (column ``periodo``) adds periods without any
    appearance."""
    names = section_names(master) if names is None else names
    matrix = master.groupBy("periodo").agg(
        *[F.count_if(F.col("seccion") == F.lit(name)).alias(name) for name in names],
        F.count("*").alias(TOTAL),
    )
    if periods is not None:
        matrix = periods.select("periodo").distinct().join(matrix, "periodo", "left").na.fill(0)
    columns = [f"`{name.replace('`', '``')}`" for name in (*names, TOTAL)]
    return matrix.selectExpr(f"{period_label('periodo')} AS periodo", *columns)


def appearances_per_period(master: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Number of appearances per period key."""
    counts = master.groupBy("periodo").agg(F.count("*").alias("apariciones"))
    if periods is not None:
        counts = periods.select("periodo").distinct().join(counts, "periodo", "left").na.fill(0)
    return counts


def _detail(master: DataFrame) -> DataFrame:
    return with_section_order(master).select("periodo", "orden", "seccion", "nro_caso", "fecha")


def all_cases_listing(master: DataFrame) -> DataFrame:
    """O3: every appearance, newest period first, then section order, then case. One range
    sort, which splits any period or section over tasks."""
    rows = _detail(master).orderBy(
        F.desc("periodo"), "orden", "seccion", F.asc_nulls_first("nro_caso"), "fecha"
    )
    return rows.selectExpr(
        "nro_caso", "fecha", "seccion AS categoria", f"{period_label('periodo')} AS periodo"
    )


def section_listings(master: DataFrame) -> DataFrame:
    """The same section by section."""
    rows = _detail(master).orderBy(
        "orden", "seccion", F.desc("periodo"), F.asc_nulls_first("nro_caso"), "fecha"
    )
    return rows.selectExpr(
        "seccion", "nro_caso", "fecha", f"{period_label('periodo')} AS periodo"
    )


def audit_overview(master: DataFrame, periods: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of the general audit by sheet name."""
    return {
        "Resumen": general_summary(master),
        "Por periodo": period_matrix(master, periods),
        "Todos": all_cases_listing(master),
        "Por seccion": section_listings(master),
    }


def period_overview(audit: DataFrame) -> dict[str, DataFrame]:
    """C8 for one period: summary and the whole listing in section order."""
    listing = with_section_order(audit).orderBy("orden", "seccion", "nro_caso")
    return {
        "Resumen": audit_summary(audit),
        "Todos": listing.select("nro_caso", "fecha", F.col("seccion").alias("categoria")),
    }
