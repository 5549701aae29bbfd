"""Scalar expressions against plain Python."""

import datetime as dt
import random

import pytest

from chatledger.functions import calendar as C
from chatledger.functions import numbers as N
from chatledger.functions import text as T
from chatledger.operators.cleaning import clean_messages, rejected_counts


def one_value(spark, sql):
    return spark.sql(f"SELECT {sql} AS v").first().v


def test_round3_is_pythons_round(spark):
    rng = random.Random(7)
    values = [k / 16 / 1000 for k in range(2000)] + [(2 * k + 1) / 2000 for k in range(3000)]
    values += [s / n / 60 for s in range(1, 200) for n in range(1, 40)]
    values += [rng.uniform(0, 10 ** rng.randint(-4, 6)) for _ in range(5000)]
    frame = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = frame.selectExpr("v", f"{N.round3('v')} AS r").collect()
    assert [r.r for r in rows] == [round(r.v, 3) for r in rows]


def test_strip_takes_all_blanks(spark):
    texts = ["  Hola ", "\x1cA\x1f", "　\t\n", "", "x y", None, "ÀÉ "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.selectExpr("t", f"{T.normalize('t')} AS n").collect()
    assert [r.n for r in rows] == [(r.t or "").strip().lower() for r in rows]


def test_quarters_blocks_and_fractions(spark):
    day = dt.datetime(2026, 6, 1)
    times = [day + dt.timedelta(seconds=s) for s in range(0, 86400, 30)]
    frame = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    rows = frame.selectExpr(
        "t", f"{C.nearest_quarter('t')} AS q", f"{C.two_hour_block('t')} AS b",
        f"{C.day_fraction('t')} AS f", f"{C.minute_of_day('t')} AS m",
    ).collect()
    for r in rows:
        seconds = (r.t - day).seconds
        quarter = round(seconds / 900) % 96
        assert r.q == f"{quarter // 4:02d}:{quarter % 4 * 15:02d}"
        start = r.t.hour - r.t.hour % 2
        assert r.b == f"{start:02d}:00 - {(start + 2) % 24:02d}:00"
        assert (r.f, r.m) == (seconds / 86400.0, seconds // 60)
    by_time = {r.t.strftime("%H:%M:%S"): r for r in rows}
    assert by_time["00:07:30"].q == "00:00" and by_time["00:22:30"].q == "00:30"
    assert by_time["23:53:00"].q == "00:00" and by_time["23:10:00"].b == "22:00 - 00:00"


@pytest.mark.parametrize("value, score, reply, pace", [
    ("0D", 100, "0 a 1", 1), ("2D", 100, "1 a 5", 1), ("2.001D", 80, "1 a 5", 2), ("5D", 80, "1 a 5", 2),
    ("10D", 50, "5 a 10", 3), ("10.001D", 20, "> 10", 4),
])
def test_bands(spark, value, score, reply, pace):
    assert one_value(spark, N.engagement_score(value)) == score
    assert one_value(spark, N.response_band(value)) == reply
    assert one_value(spark, N.pace_band_order(value)) == pace


def test_missing_values_have_no_band(spark):
    for band in (N.engagement_score, N.response_band, N.pace_band, N.response_band_order):
        assert one_value(spark, band("CAST(NULL AS DOUBLE)")) is None


def test_names(spark):
    assert one_value(spark, T.agent_name("' ANA - x - y'")) == "ANA"
    assert one_value(spark, T.agent_name("' - x'")) is None
    since, until = C.period_from_name("'casos_2024_01_02_2024_01_04.parquet'")
    assert one_value(spark, since) == dt.date(2024, 1, 2)
    assert one_value(spark, until) == dt.date(2024, 1, 4)
    assert one_value(spark, C.period_from_name("'reporte_unificado.parquet'")[0]) is None


def test_results_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist in New York on that day
    sql = ", ".join([
        N.minutes_between("TIMESTAMP_NTZ'2024-03-10 01:30:00'", "TIMESTAMP_NTZ'2024-03-10 03:30:00'"),
        C.minute_of_day("TIMESTAMP_NTZ'2024-03-10 02:30:00'"),
        C.minute_text("TIMESTAMP_NTZ'2024-03-10 02:30:00'"),
        C.day_month_year("TIMESTAMP_NTZ'2024-03-10 02:30:00'"),
        C.two_hour_block("TIMESTAMP_NTZ'2024-03-10 02:30:00'"),
        C.hour_number("TIMESTAMP_NTZ'2024-03-10 02:30:00'"),
        C.truncate_millis("TIMESTAMP_NTZ'2024-03-10 02:30:00.123999'"),
    ])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = tuple(spark.sql(f"SELECT {sql}").first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    hours = (dt.date(2024, 3, 10) - dt.date(1970, 1, 1)).days * 24 + 2
    assert row == (120.0, 150, "2024-03-10 02:30", "10/03/2024", "02:00 - 04:00", hours,
                   dt.datetime(2024, 3, 10, 2, 30, 0, 123000))


SOURCE = ("id long, nro_caso string, fecha_creacion string, direccionamiento string,"
          " usuario string, canal string, campania string, contenido string")


def test_cleaning(spark):
    rows = [
        (1, " 12 ", " 2024-01-02 03:04:05.678901 ", " Inbound", "  ", "", " x ", "y" * 5000),
        (2, None, "2024-01-02", "INBOUND", None, None, None, None),
        (3, "7", None, "INBOUND", None, None, None, None),
        (4, "7", "2024-01-02", None, None, None, None, None),
        (5, "7.5", "2024-01-02", "INBOUND", None, None, None, None),
        (6, "7", "2024", "INBOUND", None, None, None, None),
        (7, "7", "2024-1-2", "INBOUND", None, None, None, None),
        (8, "7", "2024-01-02", "OUTBOUND", None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, SOURCE)
    good = {r.id: r for r in clean_messages(frame).collect()}
    assert set(good) == {1, 8}
    first = good[1]
    assert (first.nro_caso, first.direccionamiento) == (12, "INBOUND")
    assert first.fecha_creacion == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert (first.usuario, first.canal, first.campania) == ("", None, "x")
    assert first.contenido == "y" * 5000
    assert {r.motivo: r.filas for r in rejected_counts(frame).collect()} == {
        "sin_caso": 1, "sin_fecha": 1, "direccion_desconocida": 1, "caso_ilegible": 1,
        "fecha_ilegible": 2}
