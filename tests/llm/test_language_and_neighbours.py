import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import language_mixture, nn_descent
from ratewise.llm.common import table
from ratewise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    out = QUERIES["op5_language_mixture"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out and lang_pred != 'und'").select((F.col("lang_pred") == F.col("lang")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert held > 0.95


def test_language_awkward_rows(spark):
    df = helpers.docs(spark)
    model = language_mixture.fit(df)
    rows = df.select("doc_id", language_mixture.predict_column(F.col("text"), model).alias("o")).select("doc_id", "o.*").collect()
    assert len(rows) == len(helpers.rows())
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {2, 3, 4}
    assert language_mixture.fit(helpers.empty(spark)) is None


def test_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(30)] + [(500, None), (501, [0.0] * 8), (502, [float("nan")] + [1.0] * 7), (503, [1.0]),
                                                      (None, [1.0] * 8), (504, [None] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nn_descent.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids = [i for i, _ in rows[:330]]
    x = np.array([v for _, v in rows[:330]], dtype=np.float32).astype(float)
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = []
    for k, i in enumerate(ids):
        if i % 20 == 0:
            s = x @ x[k]
            want = [ids[j] for j in np.lexsort((ids, -np.round(s, 9))) if j != k][:20]
            mine = [got[i][r][0] for r in range(1, 21)]
            hits.append(len(set(want) & set(mine)) / 20)
            assert all(abs(got[i][r][1] - s[ids.index(got[i][r][0])]) < 1e-9 for r in range(1, 21))
    assert np.mean(hits) >= 0.9
    assert nn_descent.nearest(df.filter("vec_id = 500"), F.col("id") % 20 == 0).count() == 0


def test_graph_is_refined_until_it_settles(spark, monkeypatch):
    """Many cells, and a tight cluster of a third of the vectors that is dealt to random pieces."""
    monkeypatch.setattr(nn_descent, "LEAF_MAX", 40)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 16))
    x[::3] = 2 * rng.standard_normal(16) + 0.05 * rng.standard_normal((1334, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = nn_descent.build(nn_descent.usable(df), trees=2, leaf=40)
    edges, nodes = index["edges"].toPandas(), index["nodes"].toPandas().sort_values("id")
    y = nn_descent.matrix(list(nodes["code"]))
    s = y @ y.T
    np.fill_diagonal(s, -np.inf)
    least = np.sort(s, axis=1)[:, -nn_descent.DEGREE] - 1e-4
    right = s[edges["src"], edges["dst"]] >= least[edges["src"]]
    hot = edges["src"].to_numpy() % 3 == 0
    assert right[hot].sum() >= 0.99 * 1334 * nn_descent.DEGREE
    assert right[~hot].sum() >= 0.95 * 2666 * nn_descent.DEGREE      # two rounds: 0.906


@pytest.mark.parametrize("n", [700, 2100])
def test_search_recall_over_cells_and_a_hot_cluster(spark, monkeypatch, n):
    """``nearest`` as a whole against brute force: many cells, a third of the vectors in one tight
    cluster, an id that repeats with another vector, distinct neighbours in every answer."""
    monkeypatch.setattr(nn_descent, "LEAF_MAX", 120)
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 32))
    x[::3] = 2 * rng.standard_normal(32) + 0.1 * rng.standard_normal((len(x[::3]), 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(df, F.col("id") % 20 == 0, leaf=100).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, n, 20))
    hits = []
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and len({v for _, v, _ in found}) == 20
        assert np.allclose([sc for _, _, sc in found], s[[v for _, v, _ in found]])
        hits.append(len(set(np.argsort(-s)[:20]) & {v for _, v, _ in found}) / 20)
    assert np.mean(hits) >= 0.9


def test_an_id_with_two_vectors_counts_once(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(25)] + [(3, [-5.0, 2.0]), (3, [4.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nn_descent.nearest(df, F.col("id") == 20).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 21)) and len({r["vec_id"] for r in got}) == 20
