"""The operators that SQL can express against their DuckDB SQL."""

import duckdb
import pytest

from stockyard.llm import oracle, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(oracle.oracle_sql()[key])
    df = queries.queries()[key](spark, SF)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types), strict=True))
    assert sorted(tuple(r) for r in df.select(rel.columns).collect()) == sorted(rel.fetchall())
