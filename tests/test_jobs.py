"""Files and whole jobs: periods, CSV, audit documents, reports, unified tables."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from chatledger import fixture as X
from chatledger.operators import audit as A
from chatledger.operators import unify as U
from chatledger.plans import period as P
from chatledger.operators.classify import metrics_from_results
from chatledger.operators.report import build_cases, cases_from_results, not_attended_cases
from chatledger.schemas import AUDIT, CASE_RESULTS, CASES, MESSAGES, METRICS, REPORT
from chatledger.sources import audits, jdbc, scratch, tables, versions

PERIODS = [tuple(dt.date.fromisoformat(d) for d in pair) for pair in X.PERIODS]


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("salida"))
    for period, calc in zip(PERIODS, X.CALC_TIMES):
        P.run_period(spark, X.source_messages(spark, sf_dir), folder, *period, calc_ts=calc)
        P.report_period(spark, folder, *period)
    return folder


def test_metrics_per_period(spark, base):
    counts = [tables.read_period(spark, f"{base}/metricas", *p, METRICS).count() for p in PERIODS]
    assert counts == [11, 28, 22]


def test_rerun_replaces(spark, base, sf_dir):
    before = {p: tables.read_periods(spark, f"{base}/{p}").count() for p in ("raw", "metricas", "reporte", "casos")}
    audit = audits.read_master(spark, f"{base}/auditoria_general").count()
    P.run_period(spark, X.source_messages(spark, sf_dir), base, *PERIODS[1], calc_ts=X.CALC_TIMES[1])
    P.report_period(spark, base, *PERIODS[1])
    after = {p: tables.read_periods(spark, f"{base}/{p}").count() for p in before}
    assert before == after
    assert audits.read_master(spark, f"{base}/auditoria_general").count() == audit


def test_only_metrics_and_only_extract(spark, base, sf_dir, tmp_path):
    summary = P.run_period(spark, None, base, *PERIODS[0], only_metrics=True, calc_ts=X.CALC_TIMES[0])
    values = {r.concepto: r.valor for r in summary.collect()}
    assert values["metricas_calculadas"] == 11 and len(values) == 16
    source = X.source_messages(spark, sf_dir)
    summary = P.run_period(spark, source, str(tmp_path), *PERIODS[0], only_extract=True)
    values = {r.concepto: r.valor for r in summary.collect()}
    assert values.keys() == {"estimado_origen", "total_filas", *(f"rechazados_{r}" for r in P.REJECTED)}
    assert values["estimado_origen"] == sum(v for k, v in values.items() if k != "estimado_origen")
    assert not tables.exists(spark, f"{tmp_path}/metricas")
    with pytest.raises(ValueError):
        P.run_period(spark, source, str(tmp_path), *PERIODS[0], only_extract=True, only_metrics=True)
    with pytest.raises(ValueError):
        P.run_period(spark, source, str(tmp_path), PERIODS[0][1], PERIODS[0][0])
    with pytest.raises(FileNotFoundError):
        P.compute_period(spark, str(tmp_path), dt.date(2020, 1, 1), dt.date(2020, 1, 1))


def test_empty_period_replaces_old_rows(spark, base, tmp_path):
    raw = tables.read_period(spark, f"{base}/raw", *PERIODS[0], MESSAGES)
    path = str(tmp_path)
    tables.write_period(raw, path, *PERIODS[0], MESSAGES)
    tables.write_period(raw.where("false"), path, *PERIODS[0], MESSAGES)
    assert tables.read_period(spark, path, *PERIODS[0], MESSAGES).count() == 0
    assert tables.list_periods(spark, path).count() == 1


def test_resolve_period():
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    assert P.resolve_period(day) == (day, day)
    assert P.resolve_period(since=day, until=other) == (day, other)
    assert P.resolve_period()[0] == dt.date.today() - dt.timedelta(days=1)
    for wrong in (dict(since=day), dict(since=other, until=day)):
        with pytest.raises(ValueError):
            P.resolve_period(**wrong)


def test_cases_table(spark, base):
    rows = tables.read_period(spark, f"{base}/casos", *PERIODS[1], CASES).collect()
    assert sum(r.atendido for r in rows) == 28
    assert {r.categoria_no_atendida for r in rows if not r.atendido} <= set(A.SECTION_NAMES)
    assert all(r.campania and r.canal is not None for r in rows)


@pytest.mark.parametrize("kind, schema", [(U.REPORTS, REPORT), (U.CASE_TABLES, CASES)])
def test_unify(spark, base, kind, schema):
    everything = P.unify_tables(spark, base, kind)
    assert everything.columns == schema.names
    assert everything.count() == everything.select("nro_caso").distinct().count()
    source = f"{base}/{kind.name}"
    listed = P.unify_tables(spark, base, kind, periods=PERIODS[:2], dedup=False).count()
    ranged = P.unify_tables(spark, base, kind, dt.date(2024, 1, 1), dt.date(2024, 1, 4), dedup=False).count()
    assert listed == ranged == sum(tables.read_period(spark, source, *p, schema).count() for p in PERIODS[:2])
    with pytest.raises(FileNotFoundError):
        P.unify_tables(spark, base, kind, periods=[(dt.date(2020, 1, 1), dt.date(2020, 1, 1))])
    with pytest.raises(ValueError):
        P.unify_tables(spark, base, kind, dt.date(2024, 1, 4), dt.date(2024, 1, 1))
    before = tables.read_sorted(spark, P.Folders(base).unified(kind)[0], schema).count()
    with pytest.raises(ValueError, match="no rows"):
        P.unify_tables(spark, base, kind, dt.date(2019, 1, 1), dt.date(2019, 1, 2))
    assert tables.read_sorted(spark, P.Folders(base).unified(kind)[0], schema).count() == before > 0


def test_unified_table_is_sorted(spark, base):
    """One range exchange in the job; rows and CSV files follow each other in order."""
    table = U.unify(tables.read_periods(spark, f"{base}/reporte", REPORT), U.REPORTS)
    assert table._jdf.queryExecution().executedPlan().toString().count("rangepartitioning") == 1
    P.unify_tables(spark, base)
    path, csv = P.Folders(base).unified(U.REPORTS)
    stored = tables.read_sorted(spark, path, REPORT)
    want = [r[:-1] for r in stored.orderBy(tables.ORDER_COLUMN).collect()]
    assert want == [tuple(r) for r in table.collect()] and len(want) > 30
    again = stored.repartition(5)  # the order is in the rows, not in the files
    for frame, folder in ((stored, csv), (again, f"{csv}_2")):
        if frame is again:
            tables.write_csv(frame, folder)
        files = sorted(glob.glob(f"{folder}/rango=*/part-*.csv"))
        cases = [line.split(",")[0] for f in files for line in open(f, encoding="utf-8").read().splitlines()[1:]]
        if frame is stored:
            assert cases == [str(r[0]) for r in want]
        assert sorted(cases) == sorted(str(r[0]) for r in want)
    assert tables.read_csv(spark, csv, REPORT).columns == REPORT.names


def test_failing_unify_leaves_the_old_table(spark, base, monkeypatch):
    path = P.Folders(base).unified(U.CASE_TABLES)[0]
    before = P.unify_tables(spark, base, U.CASE_TABLES, csv=False).count()
    fails = F.when(F.col("nro_caso") % 5 == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("canal"))
    with monkeypatch.context() as patch:
        real = U.unify
        patch.setattr(U, "unify", lambda *a, **k: real(*a, **k).withColumn("canal", fails))
        with pytest.raises(Exception, match="lost"):
            P.unify_tables(spark, base, U.CASE_TABLES, csv=False)
    assert tables.read_sorted(spark, path, CASES).count() == before > 0
    P.unify_tables(spark, base, U.CASE_TABLES, periods=PERIODS[:1], csv=False)
    assert 0 < tables.read_sorted(spark, path, CASES).count() < before


def test_removed_period_can_be_restored(spark, base, tmp_path):
    path, audit = f"{tmp_path}/general", audits.read_master(spark, f"{base}/auditoria_general").drop("periodo")
    assert not audits.remove_period(spark, path, "a_b")
    for key in ("a_b", "c_d"):
        audits.upsert_period(audit, path, key)
    assert audits.remove_period(spark, path, "a_b")
    assert {r.periodo for r in audits.read_master(spark, path).collect()} == {"c_d"}
    assert audits.read_period_audit(spark, path, "a_b").isEmpty()
    assert versions.restore(spark, path, "a_b") and not versions.restore(spark, path, "a_b")
    assert audits.read_period_audit(spark, path, "a_b").count() == audit.count()
    audits.remove_period(spark, path, "a_b")
    audits.upsert_period(audit.limit(3), path, "a_b")
    audits.upsert_period(audit.limit(2), path, "a_b")
    assert audits.read_period_audit(spark, path, "a_b").count() == 2
    for key in ("a_b", "c_d"):
        audits.remove_period(spark, path, key)
    assert audits.read_master(spark, path).isEmpty()
    plan = audits.read_master(spark, f"{base}/auditoria_general").where("periodo = '2024-01-01_2024-01-02'")
    assert "clave" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_listed_order_breaks_ties(spark):
    rows = [(1, dt.date(2024, 1, 1), dt.date(2024, 1, 2), "a"), (1, dt.date(2024, 1, 2), dt.date(2024, 1, 3), "b")]
    table = spark.createDataFrame(rows, "nro_caso long, periodo_desde date, periodo_hasta date, x string")
    periods = [r[1:3] for r in rows]
    assert U.unify(table, U.CASE_TABLES).first().x == "a"
    assert U.unify(table, U.CASE_TABLES, periods=periods[::-1]).first().x == "b"


def test_period_filter_prunes_directories(spark, base):
    found = U.select_periods(
        tables.read_periods(spark, f"{base}/reporte", REPORT), dt.date(2024, 1, 1), dt.date(2024, 1, 4))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "periodo_desde" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_date_range_is_pushed_down(spark, base):
    from chatledger.operators.cleaning import clean_messages, rows_between

    rows = spark.read.schema(MESSAGES).parquet(f"{base}/raw")
    plan = clean_messages(rows_between(rows, *PERIODS[0]))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(fecha_creacion" in pushed and "LessThan(fecha_creacion" in pushed


def test_missing_columns_become_null(spark):
    old = spark.createDataFrame([(1, 2)], "nro_caso long, total_mensajes long")
    new = spark.createDataFrame([(2, 3, "x")], "nro_caso long, total_mensajes long, agente string")
    merged = U.union_reports([old, new])
    assert {r.nro_caso: r.agente for r in merged.collect()} == {1: None, 2: "x"}
    assert U.latest_per_case(merged, U.REPORTS).count() == 2  # no calculation time, no periods


def test_failed_write_keeps_the_old_rows(spark, base, tmp_path):
    raw = tables.read_period(spark, f"{base}/raw", *PERIODS[0], MESSAGES)
    tables.write_period(raw, f"{tmp_path}/raw", *PERIODS[0], MESSAGES)
    audit = audits.read_master(spark, f"{base}/auditoria_general")
    audits.upsert_period(audit, f"{tmp_path}/general", "a_b")
    fails = F.when(F.col("nro_caso") % 7 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("canal"))
    with pytest.raises(Exception, match="lost"):
        tables.write_period(raw.withColumn("canal", fails), f"{tmp_path}/raw", *PERIODS[0], MESSAGES)
    with pytest.raises(Exception, match="lost"):
        audits.upsert_period(audit.withColumn("canal", fails), f"{tmp_path}/general", "a_b")
    kept = tables.read_period(spark, f"{tmp_path}/raw", *PERIODS[0], MESSAGES)
    assert kept.exceptAll(raw).isEmpty() and kept.count() == raw.count()
    assert audits.read_master(spark, f"{tmp_path}/general").count() == audit.count()


def test_named_files(spark, base, tmp_path):
    report = tables.read_period(spark, f"{base}/reporte", *PERIODS[0], REPORT).coalesce(1)
    import glob, os, shutil
    report.write.parquet(f"{tmp_path}/w")
    part = glob.glob(f"{tmp_path}/w/part-*.parquet")[0]
    os.mkdir(f"{tmp_path}/files")
    for name in ("reporte_2024-01-01_2024-01-02", "reporte_2024_01_03_2024_01_04", "reporte_unificado", "reporte_enero", "casos_2024-01-01_2024-01-02"):
        shutil.copy(part, f"{tmp_path}/files/{name}.parquet")
    found = tables.read_named_files(spark, f"{tmp_path}/files", "reporte", REPORT)
    dated = found.where("periodo_desde IS NOT NULL")
    days = {(r.periodo_desde.day, r.periodo_hasta.day) for r in dated.collect()}
    assert days == {(1, 2), (3, 4)} and dated.count() == 22
    # a file without dates counts among all files, but is in no range
    assert found.count() == 33 and U.select_periods(found, dt.date(2024, 1, 1), dt.date(2024, 1, 9)).count() == 22


def test_raw_file_without_id(spark, base, tmp_path):
    raw = tables.read_period(spark, f"{base}/raw", *PERIODS[0], MESSAGES).orderBy("id")
    raw.drop("id").coalesce(1).write.parquet(f"{tmp_path}/raw")
    found = tables.read_named_raw(spark, f"{tmp_path}/raw", MESSAGES)
    assert found.columns == MESSAGES.names
    assert [r.id for r in found.orderBy("id").collect()] == list(range(raw.count()))


def test_raw_files_without_id(spark, base, tmp_path):
    raw = tables.read_period(spark, f"{base}/raw", *PERIODS[0], MESSAGES)
    raw.drop("id").repartition(3).write.parquet(f"{tmp_path}/raw")
    found = tables.read_named_raw(spark, f"{tmp_path}/raw", MESSAGES)
    assert found.columns == MESSAGES.names
    assert [r.id for r in found.orderBy("id").collect()] == list(range(raw.count()))
    assert sorted(map(str, found.drop("id").collect())) == sorted(map(str, raw.drop("id").collect()))


def test_cases_in_one_pass(spark, base):
    for period in PERIODS:
        results = tables.read_period(spark, f"{base}/resultados", *period, CASE_RESULTS)
        wanted = build_cases(metrics_from_results(results), A.audit_rows(results))
        found = cases_from_results(results)
        assert found.schema.names == CASES.names
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
        assert found.where("NOT atendido").count() and found.where("atendido").count()


def test_entry_without_date_comes_last(spark):
    rows = [(7, "", None, None, "casos_solo_inbound"), (7, "2024-01-02 03:04", "x", None, "casos_solo_inbound"),
            (8, "", "y", None, "casos_solo_inbound")]
    best = {r.nro_caso: r for r in not_attended_cases(spark.createDataFrame(rows, AUDIT)).collect()}
    assert best[7].fecha == dt.datetime(2024, 1, 2, 3, 4) and best[7].campania == "x"
    assert best[8].fecha is None and best[8].campania == "y"


def test_without_csv(spark, sf_dir, tmp_path):
    source = X.source_messages(spark, sf_dir)
    summary = P.run_period(spark, source, str(tmp_path), *PERIODS[0], calc_ts=X.CALC_TIMES[0], csv=False)
    P.report_period(spark, str(tmp_path), *PERIODS[0], csv=False)
    P.unify_tables(spark, str(tmp_path), U.CASE_TABLES, csv=False)
    assert not [p for p in tmp_path.rglob("*_csv")]
    assert {r.concepto for r in summary.collect()} >= {"estimado_origen", "total_filas"}


def test_job_from_the_shell(spark, sf_dir, tmp_path):
    import run_job

    X.source_messages(spark, sf_dir).write.parquet(f"{tmp_path}/source")
    common = ["--base", f"{tmp_path}/out", "--since", "2024-01-01", "--until", "2024-01-02"]
    run_job.main(["period", "--source", f"{tmp_path}/source", *common], spark)
    run_job.main(["report", *common], spark)
    run_job.main(["unify", "--kind", "casos", "--base", f"{tmp_path}/out"], spark)
    assert tables.read_sorted(spark, f"{tmp_path}/out/unificado/casos", CASES).count()
    with pytest.raises(SystemExit):
        run_job.main(["report", "--base", f"{tmp_path}/out", "--since", "2024-01-01"], spark)


def test_audit_and_periods_from_the_shell(spark, sf_dir, tmp_path, capsys):
    import run_job

    X.source_messages(spark, sf_dir).write.parquet(f"{tmp_path}/source")
    base = ["--base", f"{tmp_path}/out"]
    for since, until in (("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-04")):
        run_job.main(["period", "--source", f"{tmp_path}/source", "--no-csv", *base, "--since", since, "--until", until], spark)
        run_job.main(["report", "--no-csv", *base, "--since", since, "--until", until], spark)
    run_job.main(["unify", "--no-csv", "--periods", "2024-01-02_2024-01-04", *base], spark)
    want = tables.read_period(spark, f"{tmp_path}/out/reporte", *PERIODS[1], REPORT).count()
    assert tables.read_sorted(spark, f"{tmp_path}/out/unificado/reporte", REPORT).count() == want
    capsys.readouterr()
    run_job.main(["audit", "periods", *base], spark)
    assert capsys.readouterr().out.split() == ["2024-01-01_2024-01-02", "2024-01-02_2024-01-04"]
    run_job.main(["audit", "overview", *base, "--out", f"{tmp_path}/sheets"], spark)
    for sheet in ("resumen", "por_periodo", "todos", "por_seccion"):
        assert spark.read.option("header", True).csv(f"{tmp_path}/sheets/{sheet}").count()
    run_job.main(["audit", "remove", *base, "--period", "2024-01-01_2024-01-02"], spark)
    with pytest.raises(SystemExit):
        run_job.main(["audit", "remove", *base, "--period", "2024-01-01_2024-01-02"], spark)
    run_job.main(["audit", "restore", *base, "--period", "2024-01-01_2024-01-02"], spark)
    assert audits.list_audit_periods(spark, f"{tmp_path}/out/auditoria_general").count() == 2
    unified, changed = P.Folders(f"{tmp_path}/out").unified(U.REPORTS)[0], ["unify", "--no-csv", *base, "--changed", "2024-01-02_2024-01-04"]
    run_job.main(changed, spark)  # the first time, all is read
    want = sorted(map(str, tables.read_sorted(spark, unified, REPORT).collect()))
    for file in glob.glob(f"{tmp_path}/out/reporte/*2024-01-01*/**/*.parquet", recursive=True):
        with open(file, "wb") as spoilt:
            spoilt.write(b"not read")
        os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    with pytest.raises(Exception):
        tables.read_periods(spark, f"{tmp_path}/out/reporte", REPORT).collect()
    run_job.main(changed, spark)
    assert sorted(map(str, tables.read_sorted(spark, unified, REPORT).collect())) == want and len(want) > 10
    for wrong in (["unify", *base, "--periods", "2024-01-02"], ["audit", "remove", *base], ["period", *base],
                  ["period", *base, "--jdbc-url", "jdbc:x"], ["period", *base, "--source", "x", "--jdbc-url", "jdbc:x", "--table", "t"]):
        with pytest.raises(SystemExit):
            run_job.main(wrong, spark)


def test_source_of_the_shell_job(monkeypatch):
    """A database is read through the JDBC reader, its password comes from the environment."""
    import run_job

    monkeypatch.setenv("JDBC_PASSWORD", "p")
    monkeypatch.setattr(jdbc, "read_messages", lambda spark, *dates, **options: (dates, options))
    given = run_job.parser().parse_args(["period", "--base", "b", "--jdbc-url", "jdbc:x", "--table", "t", "--user", "u"])
    assert run_job.source_rows(None, given, PERIODS[0]) == (
        PERIODS[0], dict(url="jdbc:x", table="t", user="u", password="p", driver=None, rows_per_partition=1_000_000))


def test_csv_text(spark, tmp_path):
    rows = [(1, 'a "quoted", b', True, dt.datetime(2024, 1, 2, 3, 4, 5)),
            (2, " blank ends ", False, dt.datetime(2024, 1, 2, 3, 4, 5, 120000)), (3, "", None, None)]
    frame = spark.createDataFrame(rows, "n long, t string, b boolean, f timestamp_ntz").coalesce(1)
    tables.write_csv(frame, f"{tmp_path}/csv")
    import glob
    lines = open(glob.glob(f"{tmp_path}/csv/part-*.csv")[0], encoding="utf-8").read().splitlines()
    assert lines == ["n,t,b,f", '1,"a ""quoted"", b",True,2024-01-02 03:04:05',
                     "2, blank ends ,False,2024-01-02 03:04:05.120000", "3,,,"]
    back = tables.read_csv(spark, f"{tmp_path}/csv", frame.schema).orderBy("n").collect()
    assert [tuple(r) for r in back] == [rows[0], rows[1], (3, None, None, None)]


def test_audit_documents(spark, tmp_path):
    audit = {
        "casos_solo_inbound": [
            {"nro_caso": 1, "fecha": "2024-01-02 03:04", "campania": "ñ", "canal": None}, 2,
            {"nro_caso": 3}],
        "casos_mensaje_repetido": [1], "casos_vacios": [],
    }
    (tmp_path / "a.json").write_text(json.dumps(audit, ensure_ascii=False, indent=2), encoding="utf-8")
    found = audits.read_audit_documents(spark, f"{tmp_path}/a.json")
    assert found.schema.names == AUDIT.names
    rows = {(r.seccion, r.nro_caso): r for r in found.collect()}
    assert len(rows) == 4
    first = rows["casos_solo_inbound", 1]
    assert (first.fecha, first.campania, first.canal) == ("2024-01-02 03:04", "ñ", None)
    assert rows["casos_solo_inbound", 2].fecha == "" and rows["casos_solo_inbound", 3].fecha == ""

    best = {r.nro_caso: r for r in not_attended_cases(found).collect()}
    assert {n: r.categoria_no_atendida for n, r in best.items()} == {
        1: "casos_solo_inbound", 2: "casos_solo_inbound", 3: "casos_solo_inbound"}
    assert best[2].fecha is None and best[1].fecha == dt.datetime(2024, 1, 2, 3, 4)

    master = {"2024-01-01_2024-01-02": audit, "2024-02-01_2024-02-01": {"casos_vacios": [9]}}
    (tmp_path / "m.json").write_text(json.dumps(master, indent=2), encoding="utf-8")
    general = audits.read_master_document(spark, f"{tmp_path}/m.json")
    assert {(r.periodo, r.n) for r in general.groupBy("periodo").agg(F.count("*").alias("n")).collect()} == {
        ("2024-01-01_2024-01-02", 4), ("2024-02-01_2024-02-01", 1)}


def random_audit(rnd, cases):
    odd = ['a, "b" {c} [d]', "back\\slash\\", "ñ\nü\t", "], [", "}", "{", ":", "", '"x": [', "end\\\\"]

    def case(n):
        if rnd.random() < 0.3:
            return n
        fields = {"nro_caso": n, "fecha": rnd.choice(["2024-01-02 03:04", ""]), "campania": rnd.choice([*odd, None]),
                  "canal": rnd.choice([*odd, None])}
        return {k: fields[k] for k in rnd.sample(list(fields), 4)} if rnd.random() < 0.8 else {"nro_caso": n}

    return {f"seccion {k}": [case(rnd.randint(1, 10**6)) for _ in range(rnd.choice([0, 1, cases]))] for k in range(5)}


def plain_cases(audit):
    rows = [(c if isinstance(c, dict) else {"nro_caso": c}) | {"seccion": s} for s, cases in audit.items() for c in cases]
    return sorted(str((r["nro_caso"], r.get("fecha") or "", r.get("campania"), r.get("canal"), r["seccion"])) for r in rows)


@pytest.mark.parametrize("indent", [None, 0, 2])
@pytest.mark.parametrize("block", ["128MB", "900b"])
def test_documents_are_read_in_blocks(spark, tmp_path, block, indent):
    """Any block border, also inside a string, a case, a number or a key."""
    import random

    rnd = random.Random(f"{indent}{block}")
    audits_of = {f"2024-01-0{n}_2024-01-0{n + 1}": random_audit(rnd, 60) for n in range(1, 5)}
    whole = audits_of["2024-01-02_2024-01-03"]
    (tmp_path / "docs").mkdir()
    for n, one in enumerate((whole, random_audit(rnd, 7), {})):
        (tmp_path / "docs" / f"{n}.json").write_text(json.dumps(one, ensure_ascii=n == 1, indent=indent), encoding="utf-8-sig" if n == 0 else "utf-8")
    (tmp_path / "m.json").write_text(json.dumps(audits_of, indent=indent), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b" if block != "128MB" else "4MB")
    try:
        found = audits.read_audit_documents(spark, f"{tmp_path}/docs")
        rows = sorted(str(tuple(r)) for r in found.select("nro_caso", "fecha", "campania", "canal", "seccion").collect())
        want = [json.loads((tmp_path / "docs" / f"{n}.json").read_text(encoding="utf-8-sig")) for n in range(3)]
        clean = lambda one: json.loads(json.dumps(one))
        assert rows == sorted(r for one in want for r in plain_cases(clean(one)))
        master = audits.read_master_document(spark, f"{tmp_path}/m.json")
        got = {}
        for r in master.collect():
            got.setdefault(r.periodo, []).append(str((r.nro_caso, r.fecha, r.campania, r.canal, r.seccion)))
        assert {k: sorted(v) for k, v in got.items()} == {k: plain_cases(v) for k, v in audits_of.items() if plain_cases(v)}
        if block != "128MB":
            assert spark.read.option("lineSep", ",").text(f"{tmp_path}/m.json").rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "wholetext" not in found._jdf.queryExecution().toString().lower()


def test_comma_in_a_section_name_is_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"a": [1], "b, c": [2]}))
    with pytest.raises(Exception, match="comma in its name"):
        audits.read_audit_documents(spark, f"{tmp_path}/a.json").collect()


def test_audit_lines(spark, tmp_path):
    rows = [(1, "2024-01-02 03:04", "x", None, "casos_vacios"), (2, "", None, "y", "casos_otros")]
    frame = spark.createDataFrame(rows, AUDIT)
    audits.write_audit(frame, f"{tmp_path}/json", f"{tmp_path}/csv")
    assert {tuple(r) for r in audits.read_audit(spark, f"{tmp_path}/json").collect()} == set(rows)


def test_master_periods(spark, base, tmp_path):
    master = audits.read_master(spark, f"{base}/auditoria_general")
    path = f"{tmp_path}/general"
    for key in ("a_b", "c_d", "e_f"):
        rows = master.where("periodo = '2024-01-02_2024-01-04'") if key != "c_d" else master.where("false")
        audits.upsert_period(rows, path, key)
    keys = audits.list_audit_periods(spark, path)
    assert {r.periodo for r in keys.collect()} == {"a_b", "c_d", "e_f"}
    counts = A.appearances_per_period(audits.read_master(spark, path), keys)
    assert {r.periodo: r.apariciones > 0 for r in counts.collect()} == {"a_b": True, "c_d": False, "e_f": True}
    assert audits.remove_period(spark, path, "a_b") and not audits.remove_period(spark, path, "a_b")
    assert {r.periodo for r in audits.list_audit_periods(spark, path).collect()} == {"c_d", "e_f"}


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "dbo.t")
    assert plain["dbtable"] == "dbo.t" and "partitionColumn" not in plain and "user" not in plain
    ranged = jdbc.jdbc_options("jdbc:x", "t", user="u", password="p", driver="d", id_range=(5, 90), partitions=8)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == (
        "id", "5", "91", "8")
    assert ranged["user"] == "u" and ranged["fetchsize"] == "5000"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", id_range=(2, 1))


class Session:
    """Just the two things ``scratch_dir`` asks a session."""

    def __init__(self, shared, master):
        self.conf = {"spark.checkpoint.dir": shared}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_scratch_folder(spark):
    found = scratch.scratch_dir(Session("hdfs://x/shared/", "yarn"), "x")
    assert found.startswith("hdfs://x/shared/chatledger/x-")
    with pytest.raises(ValueError):
        scratch.scratch_dir(Session(None, "yarn"), "x")
    assert scratch.scratch_dir(spark, "x") != scratch.scratch_dir(spark, "x")
