import hashlib
import math
from collections import Counter

import helpers
from pyspark.sql import functions as F

from ratewise.llm.mixing import mix, mixed, source_rates


def poisson(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c <= u:
        k += 1
        p *= rate / k
        c += p
        if k > rate + 12 * math.sqrt(rate) + 30:
            break
    return k


def draw(doc, text, rate, seed=17):
    pieces = max(1, math.ceil(rate / 500))
    total = 0
    for i in range(pieces):
        key = f"{'null' if doc is None else doc}:{hashlib.md5((text or '').encode()).hexdigest()}"
        h = hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:13]
        total += poisson(rate / pieces, int(h, 16) / 2**52)
    return total


def check(spark, **options):
    df = helpers.docs(spark)
    rates = {r["source"]: r["rate"] for r in source_rates(df, **options).collect()}
    seen = Counter((r[0], r[1]) for r in helpers.rows())
    alone = [r for r in helpers.rows() if seen[r[0], r[1]] == 1]        # equal rows draw by their place
    want = sorted((str(r[0]), str(r[1]), k + 1) for r in alone for k in range(draw(r[0], r[1], rates[r[3]])))
    got = sorted((str(r[0]), str(r[1]), r[2]) for r in mix(df, **options).select("_row.doc_id", "_row.text", "copy").collect()
                 if seen[r[0], r[1]] == 1)
    assert got == want
    return rates


def test_counts_invert_the_distribution(spark):
    rates = check(spark)
    assert set(rates) == {"s0", "s1", None}
    check(spark, weights={"s0": 1.0, "s1": 0.0001})


def test_rates_keep_the_mass(spark):
    rows = source_rates(helpers.docs(spark)).collect()
    assert math.isclose(sum(r["mass"] * r["rate"] for r in rows), sum(r["mass"] for r in rows))


def test_large_rates(spark):
    rates = check(spark, weights={"s1": 1.0})
    assert max(rates.values()) > 1 and rates["s0"] == 0


def test_order_and_empty(spark):
    df = helpers.docs(spark)
    single = lambda d: d.dropDuplicates(["doc_id", "text"])
    a = sorted(r["shuffle_key"] for r in mix(single(df)).collect())
    assert a == sorted(r["shuffle_key"] for r in mix(single(helpers.docs(spark, 5))).collect()) and len(set(a)) == len(a)
    assert mixed(df).columns == helpers.DOCS.names
    assert mixed(helpers.empty(spark)).count() == 0


def test_rows_without_an_id_draw_each_for_itself(spark):
    """Half of the rows have no id, a third is one row many times over: rates hold, copies spread."""
    rows = [(i if i % 2 else None, f"text {i}", "s") for i in range(6000)] + [(None, "hot", "s")] * 2000 + [(7, "hot", "s")] * 2000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    out = mix(df, weights={"s": 1.0}).select("_row.*", "shuffle_key", F.spark_partition_id().alias("p")).cache()
    n = {name: out.filter(test).count() for name, test in (
        ("no id", "doc_id is null and text <> 'hot'"), ("hot, no id", "doc_id is null and text = 'hot'"), ("hot", "doc_id = 7 and text = 'hot'"))}
    assert 2700 < n["no id"] < 3300 and 1800 < n["hot, no id"] < 2200 and 1800 < n["hot"] < 2200
    assert out.select("shuffle_key").distinct().count() == out.count()
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert max(sizes) < 1.3 * sum(sizes) / len(sizes)
