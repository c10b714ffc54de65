"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import digest, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cell_i", "cell_j", "cell", "n_rows", "bar"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.core_queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.core_oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
