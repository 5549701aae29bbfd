"""Message -> instant -> hour -> case: the aggregation ladder of the case analysis.

A case may hold any share of all messages, so no step sees a whole case at
message grain. Each step pre-aggregates on the map side and hands the next one
groups whose size the calendar bounds:

* ``unique_messages``  one row per distinct message. The key contains the time
  and a digest of the text, so a big case spreads over all tasks, and copies
  collapse before the shuffle. The text itself never leaves the scan stage.
* ``instants``         one row per case and millisecond.
* ``hours``            one row per case and clock hour, from at most 3.6 million
  instants each. Messages before and after the first inbound of the hour are
  told apart here.
* ``cases``            one row per case, from at most 8,784 hours a year.

Two facts make the ladder exact. A gap above 24 hours always lies between two
different hours, so comparing the end of one used hour with the start of the
next finds every one. And the first reply after the first inbound message lies
either in the hour of that message (kept apart by ``hours``) or is the first
reply of a later hour.

Buffers of the aggregations hold numbers and times only, so that Spark aggregates by
hashing, without sorting the messages. What would be text in them stands as a code of 64
bits: the channel and campaign of a row, its user, the client's text. The row that a label
comes from is found by its time and id, and ``labels`` gives back the texts of the codes
once per case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger.functions import text as X
from chatledger.functions.calendar import hour_number
from chatledger.functions.numbers import micros_between
from chatledger.functions.text import quoted
from chatledger.rules import DEFAULT_RULES, Rules

CASE = ("nro_caso",)
COPY_KEY = ("fecha_creacion", "direccionamiento", "usuario", "contenido")
HOUR_MICROS = 3_600_000_000


def _digest(text: str) -> str:
    """32 bytes that stand for a text of any length; null stays null."""
    return f"unhex(sha2({text}, 256))"


def _aggregates(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(f"{sql} AS {name}") for name, sql in expressions.items()]


def _code(*columns: str) -> str:
    """A number for the values of the columns; nulls are values of their own."""
    return f"xxhash64({', '.join(f'{c} IS NULL, coalesce({c}, {quoted(str())})' for c in columns)})"


LABELS, USER = _code("canal", "campania"), _code("usuario")
# rows without id come first
ORDER = f"coalesce(id, {-(2**63) + 1} - 1L)"


def drop_exact_copies(messages: DataFrame) -> DataFrame:
    """W1 on whole messages: the first of equal messages of a case survives. Whole texts are
    neither compared nor part of the shuffle's key, their digests are."""
    key = ("nro_caso", "fecha_creacion", "direccionamiento", "usuario")
    first = "min(struct(id, canal, campania))"
    unique = (
        messages.withColumn("texto", F.expr(_digest("contenido")))
        .groupBy(*key, "texto")
        .agg(*_aggregates({"copias": "count(*)", "primero": first, "contenido": "any_value(contenido)"}))
    )
    return unique.select(
        "primero.id", "nro_caso", "fecha_creacion", "direccionamiento", "usuario",
        "primero.canal", "primero.campania", "contenido", "copias",
    )


def marked_messages(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """Every text predicate as a flag, and the text replaced by its digest."""
    texts = messages.selectExpr(
        *keys, "id", "fecha_creacion", "direccionamiento", "usuario", "canal",
        "campania", "contenido", f"{X.normalize('contenido')} AS texto",
    )
    return texts.selectExpr(
        *keys,
        f"{hour_number('fecha_creacion')} AS hora",
        "fecha_creacion",
        "usuario",
        f"{_digest('contenido')} AS contenido",
        f"{X.speaker('direccionamiento', 'usuario', rules)} AS rol",
        f"{X.is_call_marker('texto', rules)} AS marcador",
        f"{X.is_trivial('texto', rules)} AS trivial",
        f"{X.is_multimedia('texto', rules)} AS multimedia",
        f"{X.contains_any('texto', rules.sales_terms)} AS venta",
        f"{X.contains_any('texto', rules.colleague_terms)} AS colaborador",
        f"CASE WHEN direccionamiento = 'INBOUND' AND texto <> '' THEN {_digest('texto')} END"
        " AS texto_cliente",
        f"{ORDER} AS orden",
        f"{LABELS} AS etiqueta",
        f"{USER} AS persona",
    )


def unique_messages(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """W1 with the flags carried along; they follow from the message key. The speaker
    stands for the direction: only a client writes inbound."""
    key = ("fecha_creacion", "rol", "usuario", "contenido")
    flags = ("marcador", "trivial", "multimedia", "venta", "colaborador", "texto_cliente", "persona")
    marked = marked_messages(messages, rules, keys)
    first = {"copias": "count(*)", "orden": "min(orden)", "etiqueta": "min_by(etiqueta, orden)"}
    return marked.groupBy(*keys, "hora", *key, *flags).agg(*_aggregates(first))


def instants(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """One row per case and millisecond. Call markers are not chat (P8): they count
    only as copies and as the sign of a call."""
    chat = "NOT marcador"
    expressions = {
        "duplicados": "sum(copias - 1)",
        "dup_sustantivo": "bool_or(copias > 1 AND NOT trivial)",
        "hubo_llamada": "bool_or(marcador)",
        "total": f"count_if({chat})",
        "cliente": f"count_if({chat} AND rol = 'cliente')",
        "bot": f"count_if({chat} AND rol = 'bot')",
        "humano": f"count_if({chat} AND rol = 'humano')",
        "multimedia": f"count_if({chat} AND multimedia)",
        "venta": f"bool_or({chat} AND venta)",
        "colaborador": f"bool_or({chat} AND colaborador)",
        "textos": f"count(CASE WHEN {chat} THEN texto_cliente END)",
        # 128 bits of the digest; texts are equal where both numbers are
        **{f"texto_min_{i}": f"min(CASE WHEN {chat} AND texto_cliente IS NOT NULL THEN xxhash64({i}, texto_cliente) END)" for i in (1, 2)},
        **{f"texto_max_{i}": f"max(CASE WHEN {chat} AND texto_cliente IS NOT NULL THEN xxhash64({i}, texto_cliente) END)" for i in (1, 2)},
        "etiqueta": "min_by(etiqueta, orden)",
        "etiqueta_chat": f"min_by(etiqueta, CASE WHEN {chat} THEN orden END)",
        "persona": f"min_by(persona, CASE WHEN {chat} AND rol = 'humano' THEN orden END)",
    }
    unique = unique_messages(messages, rules, keys)
    return unique.groupBy(*keys, "hora", "fecha_creacion").agg(*_aggregates(expressions))


# Aggregates that simply add up from one grain to the next.
_TOTALS = {
    name: f"sum({name})"
    for name in ("duplicados", "total", "cliente", "bot", "humano", "multimedia", "textos")
} | {
    name: f"bool_or({name})" for name in ("dup_sustantivo", "hubo_llamada", "venta", "colaborador")
} | {name: f"{name[6:9]}({name})" for name in ("texto_min_1", "texto_max_1", "texto_min_2", "texto_max_2")}


def hours(instant_rows: DataFrame, keys: Sequence[str] = CASE) -> DataFrame:
    """One row per case and hour, with the replies after the hour's first inbound."""
    by = ", ".join([*keys, "hora"])
    split = instant_rows.selectExpr(
        "*",
        f"min(CASE WHEN cliente > 0 THEN fecha_creacion END) OVER (PARTITION BY {by})"
        " AS cliente_hora",
    )
    answered = "fecha_creacion >= cliente_hora"
    chat, human = ("CASE WHEN %s > 0 THEN fecha_creacion END" % n for n in ("total", "humano"))
    reply = f"CASE WHEN humano > 0 AND {answered} THEN fecha_creacion END"
    # an instant is one row, so its time alone tells which row comes first
    expressions = _TOTALS | {
        "primera": "min(fecha_creacion)",
        "etiqueta": "min_by(etiqueta, fecha_creacion)",
        "primera_chat": f"min({chat})",
        "etiqueta_chat": f"min_by(etiqueta_chat, {chat})",
        "ultima": f"max({chat})",
        "primer_cliente": "min(cliente_hora)",
        "humano_hora": f"min({human})",
        "persona_hora": f"min_by(persona, {human})",
        "humano_tras_cliente": f"min({reply})",
        "persona_tras_cliente": f"min_by(persona, {reply})",
        "bot_hora": "min(CASE WHEN bot > 0 THEN fecha_creacion END)",
        "bot_tras_cliente": f"min(CASE WHEN bot > 0 AND {answered} THEN fecha_creacion END)",
    }
    return split.groupBy(*keys, "hora").agg(*_aggregates(expressions))


def cases(
    hour_rows: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """One row per case: counts, first and last times, t0 and the replies to it."""
    by = ", ".join(keys)
    # the ordered window first: its sort then serves the other one too
    placed = hour_rows.selectExpr(
        "*",
        f"max(ultima) OVER (PARTITION BY {by} ORDER BY hora"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anterior",
    ).selectExpr("*", f"min(primer_cliente) OVER (PARTITION BY {by}) AS t0")

    def reply(same_hour: str, any_time: str) -> str:
        return (
            f"CASE WHEN primer_cliente = t0 THEN {same_hour}"
            f" WHEN hora > {hour_number('t0')} THEN {any_time} END"
        )

    gap = micros_between("anterior", "primera_chat")
    human = reply("humano_tras_cliente", "humano_hora")
    expressions = _TOTALS | {
        "fecha_caso": "min(primera)",
        "etiqueta": "min_by(etiqueta, primera)",
        "primera_fecha": "min(primera_chat)",
        "etiqueta_chat": "min_by(etiqueta_chat, primera_chat)",
        "ultima_fecha": "max(ultima)",
        "t0": "min(t0)",
        "t_humano": f"min({human})",
        "persona": f"min_by({reply('persona_tras_cliente', 'persona_hora')}, {human})",
        "t_bot": f"min({reply('bot_tras_cliente', 'bot_hora')})",
        "hueco_largo": f"coalesce(bool_or({gap} > {rules.max_gap_hours * HOUR_MICROS}), false)",
    }
    rows = placed.groupBy(*keys).agg(*_aggregates(expressions))
    return rows.selectExpr("*", "texto_min_1 = texto_max_1 AND texto_min_2 = texto_max_2 AS texto_unico")


def labels(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The texts behind the codes: one row per channel and campaign, and per agent."""
    both = (
        f"array(struct({LABELS} AS codigo, canal, campania, CAST(NULL AS string) AS usuario),"
        f" CASE WHEN {X.speaker('direccionamiento', 'usuario', rules)} = 'humano'"
        f" THEN struct({USER} AS codigo, CAST(NULL AS string) AS canal, CAST(NULL AS string) AS campania, usuario) END)"
    )
    return messages.selectExpr(f"inline(array_compact({both}))").distinct()


def case_facts(
    messages: DataFrame, rules: Rules = DEFAULT_RULES, keys: Sequence[str] = CASE
) -> DataFrame:
    """The whole ladder. ``keys`` may hold more than the case number, for instance
    a period column, to analyse several overlapping periods in one job."""
    facts = cases(hours(instants(messages, rules, keys), keys), rules, keys)
    texts = labels(messages, rules)
    names = {
        "etiqueta": {"canal": "canal_caso", "campania": "campania_caso"},
        "etiqueta_chat": {"canal": "primer_canal", "campania": "primera_campania"},
        "persona": {"usuario": "usuario_humano"},
    }
    for code, columns in names.items():
        found = texts.select(F.col("codigo").alias(code), *[F.col(c).alias(n) for c, n in columns.items()])
        facts = facts.join(found, code, "left")
    return facts.select(
        *keys, "duplicados", "dup_sustantivo", "hubo_llamada", "total", "cliente", "bot",
        "humano", "multimedia", "venta", "colaborador", "textos", "texto_unico", "fecha_caso",
        "canal_caso", "campania_caso", "primera_fecha", "primer_canal", "primera_campania",
        "ultima_fecha", "t0", "t_humano", "usuario_humano", "t_bot", "hueco_largo",
    )


def longest_gaps(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The longest pause of each case in microseconds and whether it is too long.

    Gaps inside an hour come from a window over the instants of that hour, gaps
    between hours from a window over the hours of the case. Several messages of one
    instant have a gap of zero between them.
    """
    times = instants(messages, rules).where("total > 0")
    before = "lag(fecha_creacion) OVER (PARTITION BY nro_caso, hora ORDER BY fecha_creacion)"
    inside = times.selectExpr("*", f"{micros_between(before, 'fecha_creacion')} AS hueco")
    per_hour = inside.groupBy(*CASE, "hora").agg(
        *_aggregates(
            {
                "hueco": "max(hueco)",
                "primera": "min(fecha_creacion)",
                "ultima": "max(fecha_creacion)",
                "total": "sum(total)",
            }
        )
    )
    earlier = "lag(ultima) OVER (PARTITION BY nro_caso ORDER BY hora)"
    across = per_hour.selectExpr(
        "nro_caso", "total", f"greatest(hueco, {micros_between(earlier, 'primera')}) AS hueco"
    )
    longest = "coalesce(max(hueco), CASE WHEN sum(total) > 1 THEN 0 END)"
    return (
        across.groupBy(*CASE)
        .agg(F.expr(f"CAST({longest} AS BIGINT) AS hueco_max_us"))
        .selectExpr(
            "*",
            f"coalesce(hueco_max_us > {rules.max_gap_hours * HOUR_MICROS}, false) AS incoherente",
        )
    )
