"""DuckDB statements of the registered queries, built from shared parts.

They state the rules with windows and joins over whole cases, unlike the
aggregation ladder of the package, so the two sides check each other.
"""

from __future__ import annotations

import oracle_values as R
from chatledger.fixture import CALC_TIMES, PERIODS
from oracle_values import BLANKS


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"trim({c}, {lit(BLANKS)})"


def norm(c: str) -> str:
    return f"lower({strip(f'coalesce({c}, {lit(str())})')})"


def any_of(c: str, terms) -> str:
    return "(" + " OR ".join(f"contains({c}, {lit(t)})" for t in terms) + ")"


def in_list(c: str, values) -> str:
    return f"{c} IN ({', '.join(lit(v) for v in values)})"


def trivial(c: str) -> str:
    bare = f"trim({c}, {lit(R.TRIVIAL_STRIP)})"
    return (
        f"(length({bare}) <= {R.TRIVIAL_LENGTH} OR {in_list(bare, R.GREETINGS)}"
        f" OR {any_of(bare, R.NON_SUBSTANTIVE_PHRASES)})"
    )


def multimedia(c: str) -> str:
    bare = f"trim({c}, {lit(R.MEDIA_STRIP)})"
    return (
        f"({c} = '' OR {any_of(c, R.MEDIA_EXTENSIONS)} OR contains({c}, {lit(R.OMITTED_MEDIA)})"
        f" OR {in_list(bare, R.MEDIA_WORDS)})"
    )


def system_user(c: str) -> str:
    return (
        f"({c} IS NULL OR {c} = '' OR contains(upper({c}), {lit(R.SYSTEM_DOMAIN)})"
        f" OR starts_with(upper({c}), {lit(R.SYSTEM_PREFIX)}))"
    )


def role(d: str, u: str) -> str:
    return f"CASE WHEN {d} = 'INBOUND' THEN 'cliente' WHEN {system_user(u)} THEN 'bot' ELSE 'humano' END"


def agent(u: str) -> str:
    return f"nullif({strip(f'split_part({u}, {lit(chr(32) + chr(45) + chr(32))}, 1)')}, '')"


def round3(x: str) -> str:
    """``x`` (a column) to the nearest thousandth of its binary value, ties to even."""
    head = f"({x} * 134217729.0::DOUBLE - ({x} * 134217729.0::DOUBLE - {x}))"
    low = f"floor({x} * 1000.0::DOUBLE)"
    over = f"(({head} * 1000.0::DOUBLE - ({low} + 0.5::DOUBLE)) + ({x} - {head}) * 1000.0::DOUBLE)"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {over} > 0 OR ({over} = 0 AND {low}::BIGINT % 2 = 1)"
        f" THEN ({low} + 1) / 1000.0::DOUBLE ELSE {low} / 1000.0::DOUBLE END"
    )


def micros(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b})"


def raw_minutes(us: str) -> str:
    return f"(({us})::DOUBLE / 1e6::DOUBLE / 60.0::DOUBLE)"


def band(c: str, bands, pick) -> str:
    parts = []
    for place, (top, label) in enumerate(bands, start=1):
        test = f"{c} IS NOT NULL" if top is None else f"{c} <= {top}"
        parts.append(f"WHEN {test} THEN {pick(place, label)}")
    return "CASE " + " ".join(parts) + " END"


def icc(c: str) -> str:
    return f"CAST({band(c, R.SCORE_BANDS, lambda _, v: v)} AS INTEGER)"


def label(c: str, bands) -> str:
    return band(c, bands, lambda _, v: lit(v))


def order(c: str, bands) -> str:
    return f"CAST({band(c, bands, lambda p, _: p)} AS INTEGER)"


def block_2h(c: str) -> str:
    start = f"(hour({c}) // 2 * 2)"
    return (
        f"CASE WHEN {c} IS NOT NULL THEN lpad({start}::VARCHAR, 2, '0') || ':00 - ' ||"
        f" lpad((({start} + 2) % 24)::VARCHAR, 2, '0') || ':00' END"
    )


def seconds_of_day(c: str) -> str:
    return f"(hour({c}) * 3600 + minute({c}) * 60 + second({c}))"


def quarter(c: str) -> str:
    q = f"(round_even({seconds_of_day(c)} / 900.0::DOUBLE, 0)::BIGINT % 96)"
    return f"lpad(({q} // 4)::VARCHAR, 2, '0') || ':' || lpad(({q} % 4 * 15)::VARCHAR, 2, '0')"


# --- the message log -------------------------------------------------------------------

_DAYS = "(CASE WHEN user_id % 7 = 6 THEN 30 ELSE 1 + user_id % 7 END)"
_SHIFT = "(user_id % 5 * 86400 + user_id % 24 * 3600)"
_SECONDS = (
    f"(CASE WHEN user_id % 10 = 0 THEN off WHEN user_id % 10 <= 3 THEN {_SHIFT} + off // 600"
    f" ELSE {_SHIFT} + off // 60 END)"
)
SOURCE = f"""
base AS (
  SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS off
  FROM events),
primeras AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 211 = 5 THEN NULL WHEN event_id % 223 = 5 THEN 'x12'
         ELSE CAST(user_id * 100 + off // (86400 * {_DAYS}) AS VARCHAR) END AS nro_caso,
    CASE WHEN event_id % 227 <> 5 THEN
      strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds({_SECONDS}), '%Y-%m-%d %H:%M:%S')
    END AS fecha_creacion,
    CASE WHEN event_id % 101 = 7 THEN 'OTHER' WHEN event_type IN ('click', 'view')
         THEN ' inbound ' ELSE 'OUTBOUND' END AS direccionamiento,
    CASE WHEN event_type = 'purchase' THEN ' AGENTE ' || (user_id % 5) || ' - a@example.com '
         WHEN event_type = 'error' THEN NULL ELSE 'SAGICC SISTEMA' END AS usuario,
    CASE WHEN k < 10 THEN NULL WHEN k < 12 THEN '' ELSE 'CANAL ' || (k % 3) END AS canal,
    CASE WHEN k % 9 = 0 THEN NULL ELSE ' CAMP ' || (user_id % 4) END AS campania,
    CASE WHEN event_id % 307 = 5 THEN repeat('x', 5000)
         WHEN user_id % 11 = 3 AND event_type IN ('click', 'view') THEN 'me llega la copia de la factura'
         WHEN k < 5 THEN NULL WHEN k < 10 THEN 'foto_' || k || '.jpg' WHEN k < 15 THEN 'Hola!'
         WHEN k < 20 THEN 'gracias por todo' WHEN k < 35 THEN 'precio del combo ' || k
         WHEN k < 50 THEN 'parce, el turno ' || k WHEN k < 53 THEN 'Llamada Saliente'
         ELSE 'mensaje ' || k END AS contenido
  FROM base),
source_messages AS (
  SELECT * FROM primeras
  UNION ALL
  SELECT id + 1000000000, * EXCLUDE (id) FROM primeras WHERE id % 13 = 0)"""

_DIRECTION = f"upper({strip('coalesce(direccionamiento, ' + chr(39) * 2 + ')')})"
_VALID = (
    "nro_caso IS NOT NULL AND fecha_creacion IS NOT NULL"
    f" AND {_DIRECTION} IN ('INBOUND', 'OUTBOUND')"
    " AND TRY_CAST(nro_caso AS BIGINT) IS NOT NULL AND TRY_CAST(fecha_creacion AS TIMESTAMP) IS NOT NULL"
)


def _label(c: str) -> str:
    return f"CASE WHEN {c} <> '' THEN {strip(c)} END AS {c}"


INTERACTIONS = (
    SOURCE
    + f""",
interactions AS (
  SELECT id, TRY_CAST(nro_caso AS BIGINT) AS nro_caso,
         TRY_CAST(fecha_creacion AS TIMESTAMP) AS fecha_creacion,
         {_DIRECTION} AS direccionamiento, {_label('usuario')}, {_label('canal')},
         {_label('campania')}, contenido
  FROM source_messages WHERE {_VALID})"""
)

_PERIOD_ROWS = ", ".join(
    f"(DATE '{a}', DATE '{b}', TIMESTAMP '{c}')" for (a, b), c in zip(PERIODS, CALC_TIMES)
)
PERIOD_MESSAGES = (
    INTERACTIONS
    + f""",
periodos(periodo_desde, periodo_hasta, calc_ts) AS (VALUES {_PERIOD_ROWS}),
period_messages AS (
  SELECT i.*, p.* FROM interactions i JOIN periodos p
  ON i.fecha_creacion::DATE BETWEEN p.periodo_desde AND p.periodo_hasta)"""
)

# --- the case analysis -----------------------------------------------------------------

_CASE = ("nro_caso",)
PERIOD_KEYS = ("periodo_desde", "periodo_hasta", "calc_ts", "nro_caso")


def cascade(source: str, keys=_CASE) -> str:
    k = ", ".join(keys)
    no_sale = "NOT venta"
    return f""",
m AS (SELECT {k}, id, fecha_creacion AS f, direccionamiento AS d, usuario, canal, campania,
             contenido, {norm('contenido')} AS texto FROM {source}),
x AS (SELECT *, {trivial('texto')} AS trivial, {multimedia('texto')} AS es_multimedia,
             {any_of('texto', R.SALES_TERMS)} AS es_venta, {any_of('texto', R.COLLEAGUE_TERMS)} AS es_colab,
             {in_list('texto', R.CALL_MARKERS)} AS marcador, {role('d', 'usuario')} AS rol,
             row_number() OVER (PARTITION BY {k}, f, d, usuario, contenido ORDER BY id) AS rn
      FROM m),
todo AS (SELECT {k}, count(*) FILTER (WHERE rn > 1) AS duplicados,
                bool_or(rn > 1 AND NOT trivial) AS dup_sustantivo, bool_or(marcador) AS hubo_llamada,
                min(f) AS fecha_caso, first(canal ORDER BY f, id) AS canal_caso,
                first(campania ORDER BY f, id) AS campania_caso
         FROM x GROUP BY {k}),
chat AS (SELECT *, lag(f) OVER (PARTITION BY {k} ORDER BY f, id) AS previo,
                min(f) FILTER (WHERE rol = 'cliente') OVER (PARTITION BY {k}) AS t0
         FROM x WHERE rn = 1 AND NOT marcador),
suma AS (SELECT {k}, count(*) AS n_total, count(*) FILTER (WHERE rol = 'cliente') AS n_cliente,
                count(*) FILTER (WHERE rol = 'bot') AS n_bot,
                count(*) FILTER (WHERE rol = 'humano') AS n_humano,
                count(*) FILTER (WHERE es_multimedia) AS n_multimedia,
                bool_or(es_venta) AS venta, bool_or(es_colab) AS colaborador,
                count(*) FILTER (WHERE rol = 'cliente' AND texto <> '') AS n_textos,
                count(DISTINCT texto) FILTER (WHERE rol = 'cliente' AND texto <> '') AS textos_distintos,
                min(f) AS primera_fecha, max(f) AS ultima_fecha,
                first(canal ORDER BY f, id) AS primer_canal,
                first(campania ORDER BY f, id) AS primera_campania, min(t0) AS t0,
                min(f) FILTER (WHERE rol = 'humano' AND f >= t0) AS t_humano,
                first(usuario ORDER BY f, id) FILTER (WHERE rol = 'humano' AND f >= t0) AS usuario_humano,
                min(f) FILTER (WHERE rol = 'bot' AND f >= t0) AS t_bot,
                max({micros('previo', 'f')}) AS hueco
         FROM chat GROUP BY {k}),
hechos AS (SELECT todo.*, suma.* EXCLUDE ({k}), coalesce(n_total, 0) AS total,
                  coalesce(n_cliente, 0) AS cliente, coalesce(n_bot, 0) AS bot,
                  coalesce(n_humano, 0) AS humano, coalesce(n_multimedia, 0) AS multimedia,
                  coalesce(n_textos, 0) AS textos
           FROM todo LEFT JOIN suma USING ({k})),
juzgados AS (SELECT *, CASE
      WHEN hubo_llamada AND (cliente = 0 OR bot + humano = 0) THEN 'llamada'
      WHEN total = 0 THEN 'vacio' WHEN total = 1 THEN 'mensaje_unico'
      WHEN hueco > {R.MAX_GAP_HOURS} * 3600000000 THEN 'fechas_incoherentes'
      WHEN bot + humano = 0 THEN 'solo_inbound' WHEN cliente = 0 THEN 'solo_outbound'
      WHEN textos >= 2 AND textos_distintos = 1 THEN 'mensaje_repetido'
      WHEN {no_sale} AND colaborador THEN 'colaborador' WHEN {no_sale} THEN 'sin_palabras_venta'
      WHEN t_humano IS NULL THEN 'sin_atencion_humana' END AS motivo_descarte
   FROM hechos),
casos AS (SELECT *, motivo_descarte IS NOT NULL AS descartado, list_filter([
      CASE WHEN hubo_llamada AND motivo_descarte IS DISTINCT FROM 'llamada' THEN 'con_llamada' END,
      CASE WHEN dup_sustantivo AND (motivo_descarte IS NULL OR motivo_descarte IN
        ('solo_inbound', 'colaborador', 'sin_palabras_venta', 'sin_atencion_humana')) THEN 'duplicados' END,
      CASE WHEN motivo_descarte <> 'mensaje_unico' THEN motivo_descarte END,
      CASE WHEN motivo_descarte IS NULL AND t_bot IS NULL THEN 'sin_bot' END,
      CASE WHEN motivo_descarte IS NULL AND total > {R.LONG_CASE_MESSAGES} THEN 'extraordinario' END
    ], lambda c: c IS NOT NULL) AS categorias,
    {raw_minutes(micros('t0', 't_bot'))} AS r_bot, {raw_minutes(micros('t0', 't_humano'))} AS r_humano,
    {raw_minutes(micros('primera_fecha', 'ultima_fecha'))} AS r_total,
    CASE WHEN total >= 2 THEN ({micros('primera_fecha', 'ultima_fecha')})::DOUBLE / 1e6::DOUBLE
      / (total - 1)::DOUBLE / 60.0::DOUBLE END AS r_pausa
   FROM juzgados)"""


def metrics(keys=_CASE, calc: str = "TIMESTAMP '2024-02-01 08:00:00'") -> str:
    k = ", ".join(keys)
    return f""",
redondos AS (SELECT *, {round3('r_bot')} AS ftr_bot_min, {round3('r_humano')} AS tfr_human_min,
                    {round3('r_total')} AS tiempo_promedio_de_interaccion_min,
                    {round3('r_pausa')} AS tiempo_promedio_entre_mensajes_min FROM casos),
metricas AS (SELECT {k}, t0 AS primera_interaccion_cliente, t_bot AS primera_interaccion_bot,
    t_humano AS primera_interaccion_humano, ultima_fecha AS ultima_interaccion, ftr_bot_min,
    tfr_human_min, tiempo_promedio_de_interaccion_min, primer_canal AS canal_primera_interaccion,
    primera_campania AS campania, total AS total_mensajes, cliente AS mensajes_cliente,
    bot AS mensajes_bot, humano AS mensajes_humano, multimedia AS mensajes_multimedia,
    TRUE AS atendido_por_humano, total > 2 AS cumple_min_mensajes, TRUE AS es_venta,
    {calc} AS fecha_calculo, tiempo_promedio_entre_mensajes_min,
    {icc('tiempo_promedio_entre_mensajes_min')} AS icc_score, {agent('usuario_humano')} AS agente,
    t_bot IS NOT NULL AS tuvo_bot
  FROM redondos WHERE NOT descartado)"""


def report() -> str:
    p, r, t = "primera_interaccion_cliente", "tfr_human_min", "tiempo_promedio_entre_mensajes_min"
    return f""",
reporte AS (SELECT * REPLACE (coalesce(agente, {lit(R.NO_AGENT)}) AS agente),
    strftime({p}, '%d/%m/%Y') AS "primera_interaccion - format", {block_2h(p)} AS "Rango Horario (2h)",
    {seconds_of_day(p)} / 86400.0::DOUBLE AS primera_interaccion_hora, {quarter(p)} AS rangos_hora_atencion,
    CAST(hour({p}) * 60 + minute({p}) AS INTEGER) AS "HoraMinuto",
    {label(r, R.RESPONSE_BANDS)} AS tfr_human_rango, {order(r, R.RESPONSE_BANDS)} AS "Orden_rango",
    canal_primera_interaccion AS canal, {label(t, R.PACE_BANDS)} AS clasificacion_tiempo_entre,
    {order(t, R.PACE_BANDS)} AS "Orden_clasif_tiempo"
  FROM metricas)"""


def audit(keys=_CASE) -> str:
    extra = [k for k in keys if k != "nro_caso"]
    period = (
        ", strftime(periodo_desde, '%Y-%m-%d') || '_' || strftime(periodo_hasta, '%Y-%m-%d') AS periodo"
        if extra
        else ""
    )
    names = ", ".join(
        f"({lit(c)}, {lit(s)}, {i}, {lit(R.DESCRIPTIONS[s])})"
        for i, (c, s) in enumerate(R.SECTIONS.items(), start=1)
    )
    keep = ", " + ", ".join(extra) if extra else ""
    return f""",
secciones(categoria, seccion, orden, descripcion) AS (VALUES {names}),
marcas AS (SELECT nro_caso{keep}, fecha_caso, campania_caso, canal_caso,
                  unnest(categorias) AS categoria FROM casos),
auditoria AS (SELECT nro_caso, strftime(fecha_caso, '%Y-%m-%d %H:%M') AS fecha,
                     campania_caso AS campania, canal_caso AS canal, s.seccion{period}
              FROM marcas JOIN secciones s USING (categoria))"""


def cases_table(keys=_CASE) -> str:
    extra = [k for k in keys if k not in ("nro_caso", "calc_ts")]
    e = "".join(f", {c}" for c in extra)
    by = ", ".join([*extra, "nro_caso"])
    source = "auditoria_p" if extra else "auditoria"
    wanted = ", ".join(f"({lit(s)}, {i})" for i, s in enumerate(R.NOT_ATTENDED_SECTIONS, start=1))
    # the audit rows once more with their period dates
    dated = (
        f""",
auditoria_p AS (SELECT m.nro_caso{''.join(', m.' + c for c in extra)}, strftime(fecha_caso, '%Y-%m-%d %H:%M') AS fecha,
    campania_caso AS campania, canal_caso AS canal, s.seccion
  FROM marcas m JOIN secciones s USING (categoria))"""
        if extra
        else ""
    )
    return (
        dated
        + f""",
prioridades(seccion, prioridad) AS (VALUES {wanted}),
no_atendidos AS (SELECT * FROM (SELECT a.*, row_number() OVER (PARTITION BY {by} ORDER BY prioridad) AS rn
    FROM {source} a JOIN prioridades USING (seccion)) WHERE rn = 1),
tabla_casos AS (SELECT nro_caso{e}, fecha, coalesce(campania, {lit(R.NO_CAMPAIGN)}) AS campania,
    coalesce(canal, {lit(R.NO_CHANNEL)}) AS canal, atendido, categoria_no_atendida,
    {block_2h('fecha')} AS "Rango Horario (2h)"
  FROM (SELECT nro_caso{e}, primera_interaccion_cliente AS fecha, campania,
               canal_primera_interaccion AS canal, TRUE AS atendido,
               NULL::VARCHAR AS categoria_no_atendida FROM metricas
        UNION ALL
        SELECT nro_caso{e}, TRY_CAST(fecha AS TIMESTAMP), campania, canal, FALSE, seccion
        FROM no_atendidos))"""
    )


def summary(total_text: str) -> str:
    return f"""
SELECT orden, categoria, casos, descripcion FROM (
  SELECT coalesce(s.orden, {len(R.SECTIONS) + 1}) AS orden, coalesce(s.seccion, a.seccion) AS categoria,
         count(a.seccion) AS casos, coalesce(s.descripcion, '') AS descripcion
  FROM secciones s FULL JOIN auditoria a ON a.seccion = s.seccion GROUP BY 1, 2, 4
  UNION ALL SELECT {len(R.SECTIONS) + 2}, 'TOTAL', count(*), {lit(total_text)} FROM auditoria)"""


def one(tail: str, *parts: str) -> str:
    """A statement over the analysis of all messages."""
    return "WITH " + INTERACTIONS.lstrip() + cascade("interactions") + "".join(parts) + "\n" + tail


def periods(tail: str, *parts: str) -> str:
    """A statement over the analysis of the three periods."""
    return (
        "WITH " + PERIOD_MESSAGES.lstrip() + cascade("period_messages", PERIOD_KEYS)
        + "".join(parts) + "\n" + tail
    )


def messages(tail: str) -> str:
    return "WITH " + INTERACTIONS.lstrip() + "\n" + tail


def source(tail: str) -> str:
    return "WITH " + SOURCE.lstrip() + "\n" + tail


PM = metrics(PERIOD_KEYS, "calc_ts")
M = metrics()
A = audit()
PA = audit(PERIOD_KEYS)
PERIOD_TOTAL = "Apariciones en categorías (un caso puede estar en varias)."
GENERAL_TOTAL = "Apariciones acumuladas en todos los periodos."
P2 = "periodo_desde = DATE '2024-01-02' AND periodo_hasta = DATE '2024-01-04'"
METRIC_COLS = "* EXCLUDE (periodo_desde, periodo_hasta, calc_ts)"
_CASES_PERIOD = "nro_caso, fecha, campania, canal, atendido, categoria_no_atendida, \"Rango Horario (2h)\""
_MATRIX = ", ".join(
    f"count(*) FILTER (WHERE seccion = {lit(s)}) AS {s}" for s in R.SECTIONS.values()
)
_LATEST = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY nro_caso
  ORDER BY total_mensajes DESC NULLS LAST, fecha_calculo DESC NULLS LAST, periodo_desde, periodo_hasta) AS rn
  FROM {t}) WHERE rn = 1"""
_FIRST = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY nro_caso
  ORDER BY periodo_desde, periodo_hasta, atendido DESC) AS rn FROM {t}) WHERE rn = 1"""
_RUN_SUMMARY = "\nUNION ALL ".join(
    [
        "SELECT 'metricas_calculadas' AS concepto, count(*) FILTER (WHERE NOT descartado) AS valor FROM {c}",
        "SELECT 'casos_descartados', count(*) FILTER (WHERE descartado) FROM {c}",
        "SELECT 'registros_duplicados_eliminados', CAST(sum(duplicados) AS BIGINT) FROM {c}",
        *[
            f"SELECT {lit(s)}, count(*) FILTER (WHERE list_contains(categorias, {lit(k)})) FROM {{c}}"
            for k, s in R.SECTIONS.items()
        ],
    ]
)


def oracle_sql() -> dict[str, str]:
    ev = "FROM events"
    text = f"SELECT id, {norm('contenido')} AS texto FROM interactions"
    q: dict[str, str] = {}

    # sources
    q["s2_count_between"] = source(
        "SELECT count(*) AS total FROM source_messages WHERE TRY_CAST(fecha_creacion AS TIMESTAMP)"
        " >= DATE '2024-01-02' AND TRY_CAST(fecha_creacion AS TIMESTAMP) < DATE '2024-01-05'"
    )
    q["s3_raw_scan"] = messages(
        "SELECT * FROM interactions WHERE fecha_creacion::DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-04'"
    )
    q["s4_metrics_scan"] = periods(f"SELECT {METRIC_COLS} FROM metricas WHERE {P2}", PM)
    q["s5_audit_json"] = one("SELECT * FROM auditoria", A)
    q["s6_audit_master"] = periods("SELECT * FROM auditoria", PA)
    q["s7_report_discovery"] = (
        "WITH " + PERIOD_MESSAGES.lstrip() + "\nSELECT DISTINCT periodo_desde, periodo_hasta FROM periodos"
    )
    q["s8_period_selection"] = periods(
        "SELECT periodo_desde, periodo_hasta, nro_caso, total_mensajes FROM metricas"
        " WHERE periodo_desde >= DATE '2024-01-01' AND periodo_hasta <= DATE '2024-01-04'",
        PM,
    )

    # sinks, read back
    q["k1_raw_sink"] = (
        "WITH " + PERIOD_MESSAGES.lstrip() + "\nSELECT * EXCLUDE (calc_ts) FROM period_messages"
    )
    q["k2_raw_csv"] = messages(
        "SELECT nro_caso, fecha_creacion, direccionamiento, nullif(usuario, '') AS usuario,"
        " nullif(canal, '') AS canal, nullif(campania, '') AS campania,"
        " nullif(translate(contenido, chr(13) || chr(10), '  '), '') AS contenido FROM interactions"
    )
    q["k3_metrics_csv"] = one("SELECT * REPLACE (nullif(campania, '') AS campania) FROM metricas", M)
    q["k4_audit_csv"] = one("SELECT nro_caso, fecha, seccion AS categoria FROM auditoria", A)
    q["k5_report_sink"] = periods("SELECT * EXCLUDE (calc_ts) FROM reporte", PM, report())
    q["k6_cases_sink"] = periods(
        "SELECT * FROM tabla_casos", PM, PA, cases_table(PERIOD_KEYS)
    )
    q["k7_unified_sink"] = periods(
        f"SELECT * EXCLUDE (periodo_desde, periodo_hasta, calc_ts) FROM ({_LATEST.format(t='reporte')})",
        PM, report(),
    )
    q["k8_audit_upsert"] = periods(
        "SELECT periodo, seccion, count(*) AS casos FROM auditoria GROUP BY ALL", PA
    )
    q["k9_remove_period"] = periods(
        "SELECT periodo, seccion, count(*) AS casos FROM auditoria"
        " WHERE periodo <> '2024-01-02_2024-01-04' GROUP BY ALL", PA
    )

    # projections, filters, predicates
    q["p1_date_range"] = messages(
        "SELECT id, nro_caso, fecha_creacion FROM interactions"
        " WHERE fecha_creacion >= DATE '2024-01-02' AND fecha_creacion < DATE '2024-01-05'"
    )
    q["p2_projection"] = source("SELECT * FROM source_messages")
    q["p3_valid_rows"] = source(f"SELECT * FROM source_messages WHERE {_VALID}")
    q["p4_rejected_counts"] = source(
        f"""SELECT motivo, count(*) AS filas FROM (SELECT CASE WHEN nro_caso IS NULL THEN 'sin_caso'
          WHEN fecha_creacion IS NULL THEN 'sin_fecha'
          WHEN {_DIRECTION} NOT IN ('INBOUND', 'OUTBOUND') THEN 'direccion_desconocida'
          WHEN TRY_CAST(nro_caso AS BIGINT) IS NULL THEN 'caso_ilegible'
          WHEN TRY_CAST(fecha_creacion AS TIMESTAMP) IS NULL THEN 'fecha_ilegible' END AS motivo
          FROM source_messages) WHERE motivo IS NOT NULL GROUP BY motivo"""
    )
    q["p5_normalised_fields"] = messages("SELECT * FROM interactions")
    q["p6_text_normalise"] = messages(text)
    q["p7_contains_term"] = messages(
        f"SELECT id, {any_of('texto', R.SALES_TERMS)} AS venta,"
        f" {any_of('texto', R.COLLEAGUE_TERMS)} AS colaborador FROM ({text})"
    )
    q["p8_call_marker"] = messages(
        f"SELECT id, {in_list('texto', R.CALL_MARKERS)} AS marcador FROM ({text})"
    )
    q["p9_system_user"] = messages(f"SELECT id, {system_user('usuario')} AS sistema FROM interactions")
    q["p10_speaker"] = messages(
        f"SELECT id, {role('direccionamiento', 'usuario')} AS rol FROM interactions"
    )
    q["p11_trivial"] = messages(f"SELECT id, {trivial('texto')} AS trivial FROM ({text})")
    q["p12_multimedia"] = messages(f"SELECT id, {multimedia('texto')} AS multimedia FROM ({text})")

    for table, keys in (("documents", "doc_id"), ("conversations", "conv_id, turn")):
        q[f"p_text_predicates_{table}"] = f"""
            SELECT {keys}, md5(texto) AS texto_md5, length(texto) AS largo,
                   {any_of('texto', R.SALES_TERMS)} AS venta, {any_of('texto', R.COLLEAGUE_TERMS)} AS colaborador,
                   {in_list('texto', R.CALL_MARKERS)} AS marcador, {trivial('texto')} AS trivial,
                   {multimedia('texto')} AS multimedia
            FROM (SELECT {keys}, {norm('text')} AS texto FROM {table})"""

    # scalar functions
    since = "TIMESTAMP '2024-01-01 00:00:00'"
    q["f1_minutes_between"] = (
        f"WITH d AS (SELECT event_id, {raw_minutes(micros(since, 'ts'))} AS x {ev})"
        f" SELECT event_id, {round3('x')} AS minutos FROM d"
    )
    q["f2_engagement_score"] = f"SELECT event_id, {icc('value')} AS icc_score {ev}"
    q["f3_agent_name"] = messages(f"SELECT id, {agent('usuario')} AS agente FROM interactions")
    q["f4_two_hour_block"] = f"SELECT event_id, {block_2h('ts')} AS bloque {ev}"
    q["f5_day_fraction"] = f"SELECT event_id, {seconds_of_day('ts')} / 86400.0::DOUBLE AS fraccion {ev}"
    q["f6_minute_of_day"] = f"SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS minuto {ev}"
    q["f7_nearest_quarter"] = f"SELECT event_id, {quarter('ts')} AS cuarto {ev}"
    q["f8_response_band"] = (
        f"SELECT event_id, {label('value', R.RESPONSE_BANDS)} AS rango,"
        f" {order('value', R.RESPONSE_BANDS)} AS orden {ev}"
    )
    q["f9_pace_band"] = (
        f"SELECT event_id, {label('value', R.PACE_BANDS)} AS rango,"
        f" {order('value', R.PACE_BANDS)} AS orden {ev}"
    )
    q["f10_day_month_year"] = f"SELECT event_id, strftime(ts, '%d/%m/%Y') AS fecha {ev}"
    q["f11_minute_text"] = source(
        "SELECT id, coalesce(strftime(TRY_CAST(fecha_creacion AS TIMESTAMP), '%Y-%m-%d %H:%M'), '')"
        " AS fecha FROM source_messages"
    )
    q["f12_lenient_timestamp"] = source(
        "SELECT id, TRY_CAST(CASE WHEN id % 3 = 0 THEN direccionamiento ELSE coalesce(fecha_creacion, '')"
        " END AS TIMESTAMP) AS fecha FROM source_messages"
    )
    q["f13_missing_labels"] = messages(
        f"SELECT id, coalesce(campania, {lit(R.NO_CAMPAIGN)}) AS campania,"
        f" coalesce(canal, {lit(R.NO_CHANNEL)}) AS canal,"
        f" coalesce({agent('usuario')}, {lit(R.NO_AGENT)}) AS agente FROM interactions"
    )
    day, nxt = "strftime(ts, '%Y-%m-%d')", "strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d')"
    q["f14_period_names"] = (
        f"SELECT event_id, {day} || '_' || {nxt} AS clave, {day} || ' a ' || {nxt} AS etiqueta {ev}"
    )
    q["f15_period_from_name"] = (
        "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN ts::DATE END AS desde,"
        f" CASE WHEN event_id % 5 <> 0 THEN (ts + INTERVAL 1 DAY)::DATE END AS hasta {ev}"
    )

    # joins
    q["j1_category_sections"] = one(
        "SELECT categoria, seccion, count(*) AS casos FROM marcas JOIN secciones USING (categoria) GROUP BY ALL", A
    )
    q["j2_section_details"] = one(
        "SELECT nro_caso, a.s AS seccion, coalesce(z.orden, 14) AS orden, coalesce(z.descripcion, '') AS descripcion"
        " FROM (SELECT nro_caso, CASE WHEN nro_caso % 5 = 0 THEN 'casos_otros' ELSE seccion END AS s"
        " FROM auditoria) a LEFT JOIN secciones z ON z.seccion = a.s", A
    )
    q["j3_first_replies"] = one("SELECT nro_caso, t0, t_humano, usuario_humano, t_bot FROM hechos")

    # aggregations
    q["a1_messages_per_case"] = messages(
        "SELECT nro_caso, count(*) AS mensajes FROM interactions GROUP BY nro_caso"
    )
    q["a2_conditional_counts"] = one(
        "SELECT nro_caso, total, cliente, bot, humano, multimedia FROM hechos"
    )
    q["a3_first_last_times"] = one("SELECT nro_caso, t0, primera_fecha, ultima_fecha FROM hechos")
    q["a4_first_message_labels"] = one("SELECT nro_caso, primer_canal, primera_campania FROM hechos")
    q["a5_mean_gap"] = one(
        f"SELECT nro_caso, {round3('r_pausa')} AS pausa_media FROM casos"
    )
    q["a6_copies_removed"] = one("SELECT nro_caso, duplicados, dup_sustantivo FROM hechos")
    q["a7_any_flags"] = one(
        "SELECT nro_caso, hubo_llamada, coalesce(venta, false) AS venta,"
        " coalesce(colaborador, false) AS colaborador FROM hechos"
    )
    q["a8_client_texts"] = one(
        "SELECT nro_caso, textos, CASE WHEN textos > 0 THEN textos_distintos = 1 END AS texto_unico FROM hechos"
    )
    q["a9_case_labels"] = one("SELECT nro_caso, fecha_caso, canal_caso, campania_caso FROM hechos")
    q["a10_run_summary"] = one(_RUN_SUMMARY.format(c="casos"))
    q["a11_audit_summary"] = one(summary(PERIOD_TOTAL), A)
    q["a12_general_summary"] = periods(summary(GENERAL_TOTAL), PA)
    q["a13_period_matrix"] = periods(
        f"SELECT replace(periodo, '_', ' a ') AS periodo, {_MATRIX}, count(*) AS \"TOTAL\""
        " FROM auditoria GROUP BY periodo", PA
    )
    q["a14_appearances_per_period"] = periods(
        "SELECT periodo, count(*) AS apariciones FROM auditoria GROUP BY periodo", PA
    )

    # windows
    q["w1_exact_copies"] = messages(
        """SELECT id, nro_caso, fecha_creacion, direccionamiento, usuario, canal, campania, contenido, copias
        FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY nro_caso, fecha_creacion,
          direccionamiento, usuario, contenido) AS copias FROM interactions WINDOW w AS (PARTITION BY nro_caso,
          fecha_creacion, direccionamiento, usuario, contenido ORDER BY id)) WHERE rn = 1"""
    )
    q["w2_longest_gap"] = one(
        "SELECT nro_caso, hueco AS hueco_max_us, coalesce(hueco > 86400000000, false) AS incoherente FROM suma"
    )
    q["w3_first_client_time"] = one("SELECT nro_caso, t0 FROM suma")
    q["w4_latest_report"] = periods(
        "SELECT nro_caso, total_mensajes, fecha_calculo, periodo_desde, periodo_hasta"
        f" FROM ({_LATEST.format(t='metricas')})", PM
    )
    q["w5_first_cases"] = periods(
        f"SELECT {_CASES_PERIOD}, periodo_desde, periodo_hasta FROM ({_FIRST.format(t='tabla_casos')})",
        PM, PA, cases_table(PERIOD_KEYS),
    )
    q["w6_priority_section"] = periods(
        "SELECT nro_caso, TRY_CAST(fecha AS TIMESTAMP) AS fecha, campania, canal, FALSE AS atendido,"
        " seccion AS categoria_no_atendida FROM (SELECT *, row_number() OVER (PARTITION BY nro_caso"
        " ORDER BY prioridad, nullif(fecha, '') NULLS LAST, campania NULLS FIRST, canal NULLS FIRST) AS rn"
        " FROM auditoria JOIN (VALUES "
        + ", ".join(f"({lit(s)}, {i})" for i, s in enumerate(R.NOT_ATTENDED_SECTIONS, 1))
        + ") p(seccion, prioridad) USING (seccion)) WHERE rn = 1",
        PA,
    )

    # sorts and limits
    q["o1_messages_in_order"] = messages("SELECT * FROM interactions ORDER BY nro_caso, fecha_creacion, id")
    q["o2_final_order"] = periods(
        f"SELECT * EXCLUDE (periodo_desde, periodo_hasta, calc_ts) FROM ({_LATEST.format(t='metricas')})"
        " ORDER BY primera_interaccion_cliente, nro_caso", PM
    )
    listing = "replace(periodo, '_', ' a ') AS periodo"
    q["o3_capped_listing"] = periods(
        f"""SELECT nro_caso, fecha, seccion AS categoria, {listing}
        FROM auditoria JOIN secciones USING (seccion)
        ORDER BY auditoria.periodo DESC, orden, nro_caso""", PA
    )
    q["o4_section_listings"] = periods(f"SELECT seccion, nro_caso, fecha, {listing} FROM auditoria", PA)

    # set operations
    q["u1_union_by_name"] = periods(
        "SELECT nro_caso, total_mensajes, CASE WHEN periodo_desde <> DATE '2024-01-01' THEN agente END AS agente,"
        " CASE WHEN periodo_desde = DATE '2024-01-01' THEN icc_score END AS icc_score FROM metricas", PM
    )
    q["u2_attended_union"] = one(
        "SELECT atendido, categoria_no_atendida, count(*) AS casos FROM tabla_casos GROUP BY ALL",
        M, A, cases_table(),
    )

    # whole jobs
    q["c1_classify_cases"] = one(
        "SELECT nro_caso, array_to_string(categorias, ',') AS categorias, motivo_descarte, descartado,"
        " duplicados AS duplicados_eliminados, fecha_caso, campania_caso, canal_caso FROM casos"
    )
    q["case_outcomes"] = one(
        "SELECT coalesce(motivo_descarte, 'metricas') AS resultado, count(*) AS casos FROM casos GROUP BY 1"
    )
    q["c2_case_metrics"] = one("SELECT * FROM metricas", M)
    q["c3_audit_rows"] = one("SELECT * FROM auditoria", A)
    q["c4_build_report"] = one("SELECT * FROM reporte", M, report())
    q["c5_build_cases"] = one("SELECT * FROM tabla_casos", M, A, cases_table())
    q["c6_unify_reports"] = periods(
        f"SELECT * EXCLUDE (periodo_desde, periodo_hasta, calc_ts) FROM ({_LATEST.format(t='reporte')})",
        PM, report(),
    )
    q["c6_incremental_unify"] = q["c6_unify_reports"]
    q["c6_unify_cases"] = periods(
        f"SELECT {_CASES_PERIOD} FROM ({_FIRST.format(t='tabla_casos')})", PM, PA, cases_table(PERIOD_KEYS)
    )
    q["c6_unify_range_no_dedup"] = periods(
        f"SELECT {_CASES_PERIOD} FROM tabla_casos WHERE periodo_hasta <= DATE '2024-01-04'",
        PM, PA, cases_table(PERIOD_KEYS),
    )
    q["c7_run_period"] = periods(
        "SELECT * FROM (" + _RUN_SUMMARY.format(c=f"(SELECT * FROM casos WHERE {P2})") + ")"
        " UNION ALL SELECT 'estimado_origen', count(*) FROM source_messages"
        " WHERE TRY_CAST(fecha_creacion AS TIMESTAMP)::DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-04'"
        f" UNION ALL SELECT 'total_filas', count(*) FROM period_messages WHERE {P2}"
        f""" UNION ALL SELECT 'rechazados_' || r.motivo, count(s.motivo)
          FROM (VALUES ('sin_caso'), ('direccion_desconocida'), ('caso_ilegible')) r(motivo) LEFT JOIN (
            SELECT CASE WHEN nro_caso IS NULL THEN 'sin_caso'
              WHEN {_DIRECTION} NOT IN ('INBOUND', 'OUTBOUND') THEN 'direccion_desconocida'
              WHEN TRY_CAST(nro_caso AS BIGINT) IS NULL THEN 'caso_ilegible' END AS motivo
            FROM source_messages
            WHERE TRY_CAST(fecha_creacion AS TIMESTAMP)::DATE BETWEEN DATE '2024-01-02' AND DATE '2024-01-04') s
          USING (motivo) GROUP BY r.motivo"""
    )
    q["c8_overview_summary"] = q["a12_general_summary"]
    q["c8_overview_matrix"] = q["a13_period_matrix"]
    q["c8_overview_listing"] = q["o3_capped_listing"]
    q["c8_overview_sections"] = q["o4_section_listings"]
    q["c8_period_listing"] = q["k4_audit_csv"]
    return q
