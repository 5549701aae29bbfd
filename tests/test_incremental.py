"""Incremental unify against a full one, on random periods that are replaced and removed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chatledger.operators import unify as U

DAYS = [(dt.date(2023, 5, d), dt.date(2023, 5, d)) for d in range(1, 6)]
KINDS = {
    "prefer": (U.ReportKind("p", ("puntos",), ()), "nro_caso bigint, puntos int, x string"),
    "periods only": (U.ReportKind("q", (), ()), "nro_caso bigint, atendido boolean, x string"),
}


def period_rows(rnd, day, name):
    """Cases that most periods have, some twice, with ties and nulls."""
    cases = [c for c in range(40) for _ in range(rnd.choice((0, 0, 1, 1, 1, 2)))]
    value = (lambda: rnd.choice((None, 1, 2, 3, 3))) if name == "prefer" else (lambda: rnd.random() < 0.5)
    seen, rows = set(), []
    for case in cases:
        row = (case, value())
        if row not in seen:  # no two rows of a case and period tie
            seen.add(row)
            rows.append((*row, f"{day[0]} {row[1]}", *day))
    return rows


@pytest.mark.parametrize("name", KINDS)
def test_replaced_periods(spark, name):
    kind, ddl = KINDS[name]
    ddl += ", periodo_desde date, periodo_hasta date"
    rnd = random.Random(name)
    now = {day: period_rows(rnd, day, name) for day in DAYS[:4]}
    frame = lambda rows: spark.createDataFrame(rows, ddl).coalesce(1)
    everything = lambda: frame([r for rows in now.values() for r in rows])
    kept, lost_cases = U.candidates(everything(), kind).collect(), 0
    shape = U.candidates(everything(), kind).schema
    for changed in ([DAYS[0]], [DAYS[4]], [DAYS[0]], [DAYS[1], DAYS[2]], [DAYS[3]], [DAYS[0]]):
        for day in changed:
            now[day] = [] if rnd.random() < 0.3 else period_rows(rnd, day, name)
        fresh = frame([r for day in changed for r in now[day]])
        merged = U.merge_candidates(spark.createDataFrame(kept, shape), fresh, kind, changed).collect()
        lost = [r.nro_caso for r in merged if r.perdido]
        lost_cases += len(lost)
        assert len(lost) == len(set(lost))
        again = U.candidates(everything().where(F.col("nro_caso").isin(lost)), kind).collect()
        kept = [tuple(r)[:-1] for r in merged if not r.perdido] + [tuple(r) for r in again]
        state = spark.createDataFrame(kept, shape)
        want = U.latest_per_case(everything(), kind).collect()
        got = state.where("lugar = 1").drop("lugar", "resto").collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and want
        # what is kept is the head of the whole ranking, and the rest is known to be there
        full = {(r.nro_caso, r.lugar): r.x for r in U.candidates(everything(), kind).collect()}
        assert all(full[r.nro_caso, r.lugar] == r.x for r in state.collect())
        assert {r.nro_caso for r in U.candidates(everything(), kind).where("resto").collect()} <= {
            r.nro_caso for r in state.where("resto").collect()
        }
    assert lost_cases
