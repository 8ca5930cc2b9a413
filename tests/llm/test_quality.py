import helpers
import numpy as np
from pyspark.sql import functions as F

from ratewise.llm import quality
from ratewise.llm.common import table
from ratewise.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    out = QUERIES["op9_quality"](spark, SF001)
    rows = out.join(table(spark, SF001, "labels"), "doc_id").filter("held_out and quality is not null").select("predicted", "quality", "score").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93
    assert out.count() == table(spark, SF001, "documents").count()
    assert out.filter("score is null or score < 0 or score > 1").count() == 0


def test_awkward_rows(spark):
    df = helpers.docs(spark)
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (7, 1), (9, 1), (9, 0), (None, 1), (10, None), (12, 1)], "doc_id long, quality int")
    out = quality.scored(df, labels).select("_row.*", "score")
    assert out.columns == [*df.columns, "score"]
    s = [r["score"] for r in quality.scored(df, labels, columns=["doc_id"]).collect()]
    assert len(s) == len(helpers.rows()) and all(0 <= x <= 1 for x in s)


def test_one_label_rejects_nothing(spark):
    df = helpers.docs(spark)
    assert quality.fit(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None
    assert quality.fit(df, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert [r["score"] for r in quality.scored(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), columns=["doc_id"]).collect()] \
        == [1.0] * len(helpers.rows())
    assert quality.fit(helpers.empty(spark), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")) is None


def test_threshold_is_the_quantile_of_all_labels(spark):
    """More labels than the sample of the fit holds: the cut still leaves the share of label 0 below it."""
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels").filter("quality is not null")
    model = quality.fit(docs, labels, max_per_label=20)
    ranks = quality.ranked(docs, model, columns=["doc_id"])
    tau = quality.threshold(ranks, labels)
    rows = ranks.join(labels.withColumnRenamed("doc_id", "_id"), "_id").select("quality", F.col("_s").alias("s")).collect()
    s = sorted(r["s"] for r in rows)
    k = sum(r["quality"] == 0 for r in rows)
    assert 20 < k < len(s) and s[k - 1] < tau < s[k]


def test_smallest_is_exact(spark):
    values = [0.1] * 5000 + [0.1 + 1e-17, 1e12, -1e12, -3.5, 0.10000000000000002] + [k / 7 for k in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for k in (1, 2, 3, 2500, 5003, 5004, len(values)):
        assert quality.smallest(df, k) == sorted(values)[k - 1]


def test_every_part_of_a_long_word_counts():
    """No prefix: the end of a 10,000-character word changes its features."""
    word = "a" * 9_990
    plain, odd = quality.features(word + "a" * 10), quality.features(word + "9!Z%7?Q&2#")
    assert abs(plain[quality.HEAD:] - odd[quality.HEAD:]).max() > 0.01
    assert abs(quality.features(word + "x")[quality.HEAD:] - quality.features(word + "y")[quality.HEAD:]).max() > 0


def test_fit_against_gradient_descent(spark):
    """The weights minimise the regularised Bradley-Terry loss over the pairs the fit draws."""
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels").filter("quality is not null")
    model = quality.fit(docs, labels, max_per_label=60)
    drawn = quality.training_rows(docs, labels, max_per_label=60).orderBy("y", "o").collect()
    good, bad = ([np.array(r["x"]) for r in drawn if r["y"] == y] for y in (1, 0))
    rn = spark.range(len(good)).selectExpr("cast(id as int) AS rn").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(quality.PAIRS_PER_ROW - 1))))
    at = {(r["rn"], r["j"]): r["b"] for r in rn.withColumn("b", F.pmod(F.xxhash64("rn", "j"), F.lit(len(bad)))).collect()}
    diff = np.array([good[g] - bad[b] for (g, _), b in at.items()])
    # Spark penalises weights on features scaled to unit deviation
    won = np.array([j % 2 == 0 for _, j in at])
    seen = np.where(won[:, None], diff, -diff)
    sigma = seen.std(axis=0, ddof=1)
    z = diff @ np.array(model["w"])
    gradient = -(diff / (1 + np.exp(z))[:, None]).mean(axis=0) + 1e-3 * np.array(model["w"]) * sigma ** 2
    assert np.abs(gradient[sigma > 0] / sigma[sigma > 0]).max() < 2e-3
