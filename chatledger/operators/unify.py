"""Several period tables merged into one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.functions.calendar import date

PERIOD = ("periodo_desde", "periodo_hasta")
Period = tuple[dt.date, dt.date]


@dataclass(frozen=True)
class ReportKind:
    """How tables of one kind are merged: which row of a case wins (highest first)
    and by what the result is sorted. A key that a table lacks is skipped."""

    name: str
    prefer: tuple[str, ...]
    final_order: tuple[str, ...]


REPORTS = ReportKind("reporte", ("total_mensajes", "fecha_calculo"), ("primera_interaccion_cliente",))
CASE_TABLES = ReportKind("casos", (), ("fecha",))


def inside(since: dt.date, until: dt.date) -> str:
    """Periods that lie completely in the range. On a table partitioned by
    period this prunes directories."""
    return f"{PERIOD[0]} >= {date(since)} AND {PERIOD[1]} <= {date(until)}"


def _is(period: Period) -> str:
    return f"({PERIOD[0]} = {date(period[0])} AND {PERIOD[1]} = {date(period[1])})"


def one_of(periods: Sequence[Period]) -> str:
    """The listed periods."""
    return " OR ".join(_is(period) for period in periods) or "false"


def select_periods(
    table: DataFrame,
    since: dt.date | None = None,
    until: dt.date | None = None,
    periods: Sequence[Period] | None = None,
) -> DataFrame:
    """All periods, those inside a range, or a list of them."""
    if periods is not None:
        return table.where(one_of(periods))
    if since is not None and until is not None:
        if since > until:
            raise ValueError("the first date must not be after the last")
        return table.where(inside(since, until))
    if since is not None or until is not None:
        raise ValueError("give both dates, a list of periods, or nothing")
    return table


def union_reports(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column some tables lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _table_order(periods: Sequence[Period] | None) -> list[str]:
    """Earlier period first, or the order of an explicit list."""
    if not periods:
        return list(PERIOD)
    places = " ".join(f"WHEN {_is(period)} THEN {i}" for i, period in enumerate(periods))
    return [f"CASE {places} END"]


def _preference(table: DataFrame, kind: ReportKind, periods: Sequence[Period] | None) -> str:
    order = [f"{c} DESC NULLS LAST" for c in kind.prefer if c in table.columns]
    if PERIOD[0] in table.columns:
        order += _table_order(periods)
    if "atendido" in table.columns:
        order.append("atendido DESC")
    return ", ".join(order) or "1"


def latest_per_case(
    table: DataFrame, kind: ReportKind, periods: Sequence[Period] | None = None
) -> DataFrame:
    """One row per case. The preferred columns decide, highest first and
    nulls last, then the order of the periods; attended rows come first in a period.

    Filtering ``row_number() = 1`` makes Spark keep one candidate per case and map
    task before the shuffle."""
    place = f"row_number() OVER (PARTITION BY nro_caso ORDER BY {_preference(table, kind, periods)}) AS rn"
    return table.selectExpr("*", place).where("rn = 1").drop("rn")


def candidates(table: DataFrame, kind: ReportKind) -> DataFrame:
    """The rows of each case that an incremental unify keeps: the best and the second best, of
    different periods, with their ``lugar``, and ``resto``, whether other periods have the
    case, too. What is not kept ranks below what is."""
    order, alike = _preference(table, kind, None), table.repartition("nro_caso")  # for both windows
    first = f"row_number() OVER (PARTITION BY nro_caso, {', '.join(PERIOD)} ORDER BY {order}) AS lugar"
    best = alike.selectExpr("*", first).where("lugar = 1").drop("lugar")
    places = best.selectExpr(
        "*",
        f"row_number() OVER (PARTITION BY nro_caso ORDER BY {order}) AS lugar",
        "count(*) OVER (PARTITION BY nro_caso) > 2 AS resto",
    )
    return places.where("lugar <= 2")


def merge_candidates(kept: DataFrame, fresh: DataFrame, kind: ReportKind, changed: Sequence[Period]) -> DataFrame:
    """``kept`` candidates after the ``changed`` periods got the rows ``fresh`` (none for a period
    that was removed), with ``perdido``: of these cases nothing is known any more, as
    all that was kept was of a changed period and there was more. Each such case is one row.

    Where more was left out, a new row counts only down to the last row that stays: below it may
    rank what was left out."""
    table = kept.drop("lugar", "resto")
    order, columns = _preference(table, kind, None), [f"`{c}`" for c in table.columns]
    old = kept.drop("lugar").withColumn("estado", F.expr(f"if({one_of(changed)}, 2, 0)"))
    new = candidates(fresh, kind).drop("lugar").withColumns({"resto": F.lit(False), "estado": F.lit(1)})
    both = "(PARTITION BY nro_caso)"
    # rows of changed periods (2) come last; then places are those of the rows that stay
    ranked = old.unionByName(new).selectExpr(
        *columns,
        "estado",
        f"row_number() OVER (PARTITION BY nro_caso ORDER BY estado = 2, {order}) AS lugar",
        f"bool_or(resto) OVER {both} AS habia",
        f"count_if(estado < 2) OVER {both} AS quedan",
    ).selectExpr("*", f"max(CASE WHEN estado = 0 THEN lugar END) OVER {both} AS ultimo")
    stays = "estado < 2 AND lugar <= if(habia, least(2, coalesce(ultimo, 0)), 2)"
    return ranked.selectExpr(
        *columns,
        "lugar",
        "habia OR quedan > 2 AS resto",
        f"if({stays}, false, if(habia AND ultimo IS NULL AND lugar = 1, true, NULL)) AS perdido",
    ).where("perdido IS NOT NULL")


def sort_unified(table: DataFrame, kind: ReportKind) -> DataFrame:
    """O2: final order. The case number breaks ties, which also lets the range
    partitioning split a date that very many rows share."""
    keys = [F.col(c).asc_nulls_last() for c in (*kind.final_order, "nro_caso") if c in table.columns]
    return table.orderBy(*keys) if keys else table


def unify(
    table: DataFrame,
    kind: ReportKind = REPORTS,
    since: dt.date | None = None,
    until: dt.date | None = None,
    periods: Sequence[Period] | None = None,
    dedup: bool = True,
) -> DataFrame:
    """Selected periods of ``table`` as one sorted table without period columns."""
    chosen = select_periods(table, since, until, periods)
    if dedup and "nro_caso" in chosen.columns:
        chosen = latest_per_case(chosen, kind, periods)
    return sort_unified(chosen, kind).drop(*PERIOD)
