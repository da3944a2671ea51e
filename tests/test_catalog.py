"""Driver contract on the smallest scale factor: every query runs and matches its SQL oracle."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stockyard.plans import catalog, oracle

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN"}


def _norm(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float) and math.isnan(x):
            return "nan"
        return x

    return sorted((tuple(v(r[i]) for i in idx) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["supplier_name", "reliability", "total_orders"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    assert sorted(df.columns) == sorted(dcols)
    assert {c: SPARK_TO_DUCK[t] for c, t in df.dtypes} == dict(zip(dcols, dtypes))
    assert _norm(srows, df.columns) == _norm(rel.fetchall(), dcols)
