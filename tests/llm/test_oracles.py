"""Registered queries of the training-data operators with SQL, against DuckDB."""

import pytest

import __spark_entry__ as E
from check_oracle import digest, duck

SF = "/root/testdata/sf0.001"
SQL = {k: v for k, v in E.oracle_sql().items() if not k.startswith("q_")}


def test_which_queries_have_sql():
    assert set(SQL) == {"op9_benchmark_decontamination", "op11_hard_negatives", "op13_minhash_near_dedup"}
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {k.split("_")[0] for k in E.queries() if not k.startswith("q_")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    rows, rel = [tuple(r) for r in df.collect()], duck(SF).execute(SQL[name])
    columns = [d[0] for d in rel.description]
    found = rel.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(found)
    assert digest(df.columns, rows)[0] == digest(columns, found)[0]
