"""Hot cases, random logs against SQL, capped lists, and the shape of the plans."""

import random
import re

import duckdb
import pytest

import oracle_queries as O
from chatledger.operators import audit as A
from chatledger.operators import grains as G
from chatledger.operators.classify import case_metrics, classify_cases
from chatledger.operators.unify import REPORTS, latest_per_case
from compare import difference

TEXTS = ["precio", "hola", "Hola!", "parce", "Llamada Saliente", "foto.jpg", "gracias por todo",
         "mensaje uno", "mensaje dos", " Mensaje DOS ", ""]


def random_log(spark, seed, hot):
    """About 12,000 messages; ``hot`` of every 3 belong to one case. Times are coarse, so
    many messages share one, and copies are frequent."""
    pick = lambda n, salt: f"pmod(xxhash64(id, {seed}, {salt}), {n})"
    texts = ", ".join(T for T in (f"'{t}'" for t in TEXTS))
    case = f"CASE WHEN {pick(3, 1)} < {hot} THEN 0 ELSE 1 + {pick(900, 2)} END"
    spread = f"element_at(array(60, 4000, 90000, 400000), 1 + CAST(pmod(xxhash64({case}, {seed}), 4) AS INT))"
    return spark.range(12000).selectExpr(
        "id",
        f"CAST({case} AS BIGINT) AS nro_caso",
        f"timestampadd(SECOND, CAST(pmod(xxhash64(id, {seed}, 3), {spread}) AS BIGINT), TIMESTAMP_NTZ'2024-01-01 09:58:00')"
        " AS fecha_creacion",
        f"IF({pick(2, 4)} = 0, 'INBOUND', 'OUTBOUND') AS direccionamiento",
        f"element_at(array('SAGICC A', 'ANA - a', NULL), 1 + CAST({pick(3, 5)} AS INT)) AS usuario",
        f"element_at(array('w', NULL, ''), 1 + CAST({pick(3, 6)} AS INT)) AS canal",
        f"concat('c', {pick(3, 7)}) AS campania",
        f"nullif(element_at(array({texts}), 1 + CAST({pick(len(TEXTS), 8)} AS INT)), '') AS contenido",
    )


def sql_over(table, tail, *parts):
    return "WITH nada AS (SELECT 1)" + O.cascade(table) + "".join(parts) + "\n" + tail


@pytest.mark.parametrize("seed, hot", [(1, 0), (2, 1), (3, 1), (4, 3)])
def test_random_logs(spark, seed, hot):
    log = random_log(spark, seed, hot)
    con = duckdb.connect()
    mensajes = log.toArrow()  # noqa: F841  (DuckDB reads the local variable)
    con.register("mensajes", mensajes)
    facts = ("SELECT nro_caso, duplicados, dup_sustantivo, hubo_llamada, total, cliente, bot, humano,"
             " multimedia, textos, fecha_caso, canal_caso, campania_caso, primera_fecha, ultima_fecha,"
             " primer_canal, primera_campania, t0, t_humano, usuario_humano, t_bot FROM hechos")
    ours = G.case_facts(log).drop("venta", "colaborador", "texto_unico", "hueco_largo")
    assert difference(ours, con, sql_over("mensajes", facts)) is None
    assert difference(
        case_metrics(log, O.CALC_TIMES[0]), con, sql_over("mensajes", "SELECT * FROM metricas", O.M)
    ) is None
    outcome = "SELECT nro_caso, array_to_string(categorias, ',') AS categorias FROM casos"
    ours = classify_cases(log).selectExpr("nro_caso", "array_join(categorias, ',') AS categorias")
    assert difference(ours, con, sql_over("mensajes", outcome)) is None
    gaps = ("SELECT nro_caso, hueco AS hueco_max_us, coalesce(hueco > 86400000000, false) AS incoherente"
            " FROM suma")
    assert difference(G.longest_gaps(log), con, sql_over("mensajes", gaps)) is None


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_case_plan(spark, sf_dir, tmp_path):
    """Four shuffles from message to case; text and whole cases never cross one. Messages and
    instants are aggregated by hashing; the texts of labels come from their distinct values."""
    from chatledger import fixture

    fixture.interactions(spark, sf_dir).write.parquet(f"{tmp_path}/raw")
    messages = spark.read.parquet(f"{tmp_path}/raw")
    plan = plan_of(case_metrics(messages, "2024-01-01"))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    names = [re.sub(r"#\d+L?", "", k).split(", ") for k in keys]
    assert names[4:] == [["codigo", "canal", "campania", "usuario"]] * 3
    assert "SortAggregate" not in plan
    below_hours = plan.split("Exchange hashpartitioning(nro_caso")[3]
    assert below_hours.count("HashAggregate") >= 2 and "Sort" not in below_hours.split("Exchange hashpartitioning(codigo")[0]
    assert names[0] == ["nro_caso"]
    assert names[1] == ["nro_caso", "hora"]
    assert names[2] == ["nro_caso", "hora", "fecha_creacion"]
    assert names[3][:6] == ["nro_caso", "hora", "fecha_creacion", "rol", "usuario", "contenido"]
    assert "sha2" in plan and "Python" not in plan and "Pandas" not in plan
    # a window by case alone sees hours, never messages
    assert "partial_min" in plan.split("hashpartitioning(nro_caso#")[1]


def test_partitioning_by_case_is_reused(spark, sf_dir, tmp_path):
    """A caller who knows that no case is large needs one shuffle of whole rows, and a narrow
    one for the labels; results are equal."""
    from chatledger import fixture

    fixture.interactions(spark, sf_dir).write.parquet(f"{tmp_path}/raw")
    messages = spark.read.parquet(f"{tmp_path}/raw")
    by_case = case_metrics(messages.repartition("nro_caso"), "2024-01-01")
    keys = set(re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", plan_of(by_case))))
    assert keys == {"nro_caso", "codigo, canal, campania, usuario"}
    ladder = case_metrics(messages, "2024-01-01")
    assert sorted(map(str, by_case.collect())) == sorted(map(str, ladder.collect()))


def test_latest_report_prunes_before_the_shuffle(spark, sf_dir):
    table = spark.range(10).selectExpr(
        "id AS nro_caso", "id AS total_mensajes", "current_timestamp() AS fecha_calculo",
        "DATE'2024-01-01' AS periodo_desde", "DATE'2024-01-02' AS periodo_hasta")
    plan = plan_of(latest_per_case(table.repartition(3), REPORTS))
    before = plan.split("Exchange hashpartitioning(nro_caso")[1]
    assert "WindowGroupLimit" in before


def test_report_has_no_shuffle(spark):
    from chatledger.operators.report import build_report
    from chatledger.schemas import METRICS

    assert "Exchange" not in plan_of(build_report(spark.createDataFrame([], METRICS)))


AUDIT_COLUMNS = "nro_caso long, fecha string, campania string, canal string, seccion string, periodo string"


def audit_log(spark):
    rng = random.Random(3)
    names = [*A.SECTION_NAMES[:4], "casos_otros"]
    rows = set()
    for period in ("2024-01-01_2024-01-02", "2024-01-02_2024-01-04", "2024-02-01_2024-02-01"):
        for section in names:
            for _ in range(rng.choice([5, 40, 700])):
                rows.add((rng.randrange(5000), section, period))
    # one case number far away from all others
    rows |= {(10**15, names[0], p) for _, _, p in rows}
    data = [(c, "2024-01-01 00:00", None, None, s, p) for c, s, p in sorted(rows)]
    return data, spark.createDataFrame(data, AUDIT_COLUMNS).repartition(5)


def test_listings_are_whole_and_in_order(spark):
    data, frame = audit_log(spark)
    place = {s: i for i, s in enumerate(A.SECTION_NAMES)}
    rank = lambda r: (place.get(r[4], 99), r[4], r[0])
    ordered = [r for p in sorted({r[5] for r in data}, reverse=True)
               for r in sorted((r for r in data if r[5] == p), key=rank)]
    listing = A.all_cases_listing(frame)
    assert [(r.nro_caso, r.categoria, r.periodo) for r in listing.collect()] == [
        (r[0], r[4], r[5].replace("_", " a ")) for r in ordered]
    plan = plan_of(A.all_cases_listing(frame))
    assert plan.count("rangepartitioning") == 1 and "SinglePartition" not in plan and "Limit" not in plan

    found = A.section_listings(frame).collect()
    assert len(found) == len(data)
    for section in {r[4] for r in data}:
        wanted = [(r[0], r[5].replace("_", " a ")) for r in ordered if r[4] == section]
        assert [(r.nro_caso, r.periodo) for r in found if r.seccion == section] == wanted


def test_summary_and_matrix(spark):
    data, frame = audit_log(spark)
    rows = A.general_summary(frame).orderBy("orden").collect()
    assert [r.categoria for r in rows] == [*A.SECTION_NAMES, "casos_otros", "TOTAL"]
    counts = {r.categoria: r.casos for r in rows}
    assert counts["TOTAL"] == len(data) and counts["casos_vacios"] == 0
    assert counts["casos_otros"] == sum(r[4] == "casos_otros" for r in data)
    periods = spark.createDataFrame([(p,) for p in {r[5] for r in data} | {"2024-03-01_2024-03-01"}], "periodo string")
    matrix = {r.periodo: r for r in A.period_matrix(frame, periods).collect()}
    assert len(matrix) == 4 and matrix["2024-03-01 a 2024-03-01"].TOTAL == 0
    assert sum(r.TOTAL for r in matrix.values()) == len(data)
    # a section that is not a standard one has its column, so rows add up
    assert sum(r.casos_otros for r in matrix.values()) == counts["casos_otros"] > 0
    assert all(sum(r[name] for name in (*A.SECTION_NAMES, "casos_otros")) == r.TOTAL for r in matrix.values())
    long = A.appearances_per_section(frame).agg({"casos": "sum"}).first()[0]
    assert long == len(data)
    with pytest.raises(ValueError):
        A.section_names(frame, most=0)
    per = {r.periodo: r.apariciones for r in A.appearances_per_period(frame, periods).collect()}
    assert per["2024-03-01_2024-03-01"] == 0 and sum(per.values()) == len(data)


def test_empty_audit(spark):
    _, frame = audit_log(spark)
    empty = frame.where("false")
    assert A.all_cases_listing(empty).count() == 0
    rows = A.audit_summary(empty).orderBy("orden").collect()
    assert len(rows) == 14 and all(r.casos == 0 for r in rows)
