"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

import __spark_entry__ as E
from tarmac.plans import catalog as C
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

KEYS = sorted(C.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(C.ORACLE) == set(C.QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    n, problems = compare(spark, con, key, C.QUERIES[key], C.ORACLE[key], SF_SMALL)
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["codice", "aeroporto_partenza", "numero_voli", "ritardo_minimo",
                          "ritardo_massimo", "ritardo_medio", "tasso_cancellazione", "mese"]
    assert df.count() == 2429
