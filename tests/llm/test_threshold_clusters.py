"""Centroid clustering against brute force in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from ratewise.llm import threshold_clusters as tc

SCHEMA = "vec_id long, embedding array<float>, cluster string, x int, id string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "extra", 1, "e") for i, v in rows], SCHEMA).repartition(parts)


def nearest(v, centroids):
    d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
    return d.index(min(d)), min(d)


def brute(rows, k=8, rounds=10, dims=64):
    own = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
           if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(own, key=key)[:k]]
    for _ in range(rounds):
        dealt = [[] for _ in centroids]
        for _, v in own:
            dealt[nearest(v, centroids)[0]].append(v)
        centroids = [[sum(col) // len(vs) for col in zip(*vs, strict=True)] if vs else c for vs, c in zip(dealt, centroids, strict=True)]
    last = [(i, *nearest(v, centroids)) for i, v in own]
    inertia = [sum(d for _, c, d in last if c == j) for j in range(len(centroids))]
    return sorted(((i, c, d, inertia[c], sum(inertia), centroids[c]) for i, c, d in last), key=str)


def found(df, **options):
    return sorted(((r["id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], list(r["centroid"]))
                   for r in tc.clusters(df, **options).collect()), key=str)


def random_rows(n, seed=1, spread=0.4):
    rng = random.Random(seed)
    mids = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [m + rng.gauss(0, spread) for m in mids[i % 5]]) for i in range(n)]


def test_random_vectors(spark):
    rows = random_rows(400)
    assert found(table(spark, rows)) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(60, 2)
    rows += [(None, rows[3][1]), (70, rows[4][1]), (70, rows[4][1]), (70, rows[5][1]), (71, None), (72, []), (73, [1.0] * 63),
             (74, [None] + [0.0] * 63), (75, [nan] + [0.0] * 63), (76, [inf] + [0.0] * 63), (77, [0.0] * 64), (78, [-0.0005] * 64)]
    assert found(table(spark, rows)) == brute(rows)


def test_ties_and_empty_clusters(spark):
    """Few distinct vectors: equal start centroids, equidistant points, clusters that stay empty."""
    rows = [(i, [float(i % 3 == 0)] * 32 + [float(i % 2)] * 32) for i in range(50)]
    assert found(table(spark, rows)) == brute(rows)
    few = rows[:3]
    assert found(table(spark, few)) == brute(few)


def test_empty_table(spark):
    assert tc.clusters(table(spark, [])).count() == 0
    assert tc.clusters(table(spark, [(1, None), (2, [1.0])])).count() == 0


def test_extreme_components_saturate(spark):
    rows = random_rows(20, 3) + [(90, [3e38] * 64), (91, [-3e38] * 64)]
    got = {r["id"]: r for r in tc.clusters(table(spark, rows), k=3).collect()}
    assert len(got) == 22 and all(0 <= r["distance"] <= tc.LONG_MAX for r in got.values())


@pytest.mark.parametrize("k", [1, 2, 8, 40])
def test_walk_meets_the_nearest(k):
    """The threshold walk alone, over many centroids, few dimensions and many ties."""
    rng = np.random.default_rng(k)
    for dims, high in ((1, 6), (3, 4), (64, 900)):
        c = rng.integers(-high, high, (k, dims)).tolist()
        x = rng.integers(-high, high, (300, dims))
        number, dist = tc.Lists(c).nearest(x)
        assert list(zip(number.tolist(), dist.tolist(), strict=True)) == [nearest(v, c) for v in x.tolist()]


def test_walk_ends_early():
    """A vector beside its centroid does not meet them all: the frontier sum stops the walk."""
    walk = tc.Lists([[1000 * j, 1000 * j] for j in range(200)])
    assert walk.nearest(np.array([[1, 2], [100_003, 100_001]]))[0].tolist() == [0, 100]
    assert walk.compared <= 6
