"""Every registered query with SQL against the DuckDB oracle (sf0.001 for speed)."""

import pytest

import __spark_entry__ as E
from check_oracle import digest, duck
from conftest import SF_SMALL

SQL = {k: v for k, v in E.oracle_sql().items() if k.startswith("q_")}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


def test_every_query_has_sql_or_trains_a_forest():
    own = {k for k in E.queries() if k.startswith("q_")}
    assert own - set(SQL) == {"q_benchmark", "q_backtest", "q_forecast"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "recency" in df.columns
