"""Registered queries against their DuckDB oracles on the smallest fixture."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import duck, rows_of

from .conftest import SF_SMALL

FAST = [n for n in E.oracle_sql() if not n.startswith(("k9_dbscan",))] + ["k9_dbscan_anual_altitud"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["departamento", "nombre_mes", "periodo", "precipitacion_promedio", "num_estaciones"]
    assert df.count() > 0
