"""A third of all rows on one key: joins are split by adaptive execution, results stay exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.operators.recommend import score_pairs
from ratewise.operators.upsert import apply_actions, classify

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df):
    df.collect()     # runs this frame's own execution, so its adaptive plan is the final one
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_pairs_scored_exactly(spark, skew_conf):
    n = 30000
    # user 0 owns a third of the pairs
    pairs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).cast("int").alias("user_id"),
        (F.col("id") % 97).cast("int").alias("movie_id"))
    rng = np.random.default_rng(0)
    u = {i: rng.normal(size=4).astype(np.float32) for i in range(501)}
    v = {i: rng.normal(size=4).astype(np.float32) for i in range(97)}
    uf = spark.createDataFrame([(i, [float(x) for x in a]) for i, a in u.items()], "id int, features array<float>")
    vf = spark.createDataFrame([(i, [float(x) for x in a]) for i, a in v.items()], "id int, features array<float>")
    scored = score_pairs(pairs, uf, vf)
    text = _final_plan(scored)
    assert "SortMergeJoin(skew=true)" in text, text
    got = scored.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("s")).collect()
    assert sum(r.n for r in got) == n
    hot = [r for r in got if r.user_id == 0][0]
    want = sum(float(np.dot(u[0].astype(float), v[m].astype(float))) for m in [i % 97 for i in range(0, n, 3)])
    assert hot.n == n // 3 and hot.s == pytest.approx(want)


def test_hot_user_in_target_upsert(spark, skew_conf):
    # the stored table repeats one user on a third of its rows
    target = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("int").alias("user_id"),
        F.lit("old").alias("res"), F.lit("2024-01-30").alias("day"))
    incoming = spark.createDataFrame([(0, "new"), (1, "new"), (-5, "new")], "user_id int, res string")
    after = apply_actions(target, classify(incoming, target, "2024-01-31"))
    rows = after.filter(F.col("user_id").isin(0, 1, -5)).collect()
    assert sorted(tuple(r) for r in rows) == [(-5, "new", "2024-01-31"), (0, "new", "2024-01-31"),
                                             (1, "new", "2024-01-31")]
    assert after.count() == 30000 - 10000 - 1 + 3
