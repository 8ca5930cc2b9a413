"""Registered queries against their SQL, and the pipeline's stages on awkward rows."""

import duckdb
import helpers
import pytest

import corpus_pipeline
from ratewise.llm.oracle import ORACLE_SQL
from ratewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    cols = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in cols]
    rows = sorted(tuple(r[i] for i in order) for r in want.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect())) == rows


def test_each_stage_keeps_the_columns(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (helpers.docs(spark), helpers.empty(spark)):
            out = stage(spark, df, SF)
            assert out.columns == df.columns, name
            out.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.filter("not round_trip").count() == 0
    assert out.count() > 50 and out.filter("size(ids) != n_pieces").count() == 0
