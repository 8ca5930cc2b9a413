"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from ratewise.plans.catalog import QUERIES
from ratewise.plans.oracle import ORACLE_SQL
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = _canon([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["user_id", "res", "day"]
