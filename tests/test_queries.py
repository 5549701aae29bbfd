"""Every registered query against its SQL twin on the smallest data set."""

import pytest

import __spark_entry__ as entry
import oracle_queries
import spark_queries
from compare import difference

QUERIES = spark_queries.queries()  # those of llm have tests of their own
SQL = oracle_queries.oracle_sql()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    assert {r.resultado: r.casos for r in entry.entry(spark).collect()} == {
        "metricas": 44, "mensaje_unico": 20, "llamada": 7, "fechas_incoherentes": 3,
        "solo_inbound": 6, "solo_outbound": 23, "mensaje_repetido": 16, "colaborador": 10,
        "sin_palabras_venta": 12, "sin_atencion_humana": 31,
    }
