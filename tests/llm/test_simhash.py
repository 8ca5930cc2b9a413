import random

import helpers
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratewise.llm.simhash_dedup import keep_one, links, near_dedup, simhash


def slow_simhash(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    sh = [" ".join(low[i:i + k]) for i in range(len(low) - k + 1)] or ([" ".join(low)] if low else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(items, bits=3):
    """items: list of (id, fp); brute-force components, smallest id of each."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(items))]


def test_fingerprint():
    for t in [r[1] for r in helpers.rows() if r[1] is None or len(r[1]) < 9000]:
        assert simhash(t) == slow_simhash(t)


def test_awkward_rows(spark):
    items = [(r[0], simhash(r[1])) for r in helpers.rows()]
    want = sorted(((d, f, c) for (d, f), c in zip(items, classes(items))), key=str)
    got = sorted(((r[0], r[1] % 2**64, r[2]) for r in near_dedup(helpers.docs(spark)).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("cell", [4, 1024])
def test_links_against_brute_force(spark, cell):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(rng.choice([0, 1, 3, 25])):
            x = rng.choice([c, rng.choice(sorted(fps))])
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5])):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    got = [(a % 2**64, b % 2**64) for a, b in links(df, cell=cell).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in got)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in got:
        root[max(find(a), find(b))] = min(find(a), find(b))
    brute = classes([(i, f) for i, f in enumerate(fps)])
    assert [fps.index(find(f)) for f in fps] == brute


def test_many_near_copies_are_one_component(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    fps = {base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (1500, 2))}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    from ratewise.llm.components import components
    e = links(df, cell=128)
    lab = components(e)
    assert lab.count() == len(fps) and lab.select("label").distinct().count() == 1


def test_keep_one(spark):
    out = keep_one(helpers.docs(spark))
    assert out.columns == helpers.DOCS.names
    items = [(r[0], simhash(r[1])) for r in helpers.rows()]
    comp = classes(items)
    kept = [r["doc_id"] for r in out.collect()]
    # one row of each component; (doc 15 has two texts, in two components, so it may stay twice)
    assert set(kept) == set(comp) and len(kept) == len({(c, f) for (d, f), c in zip(items, comp) if d == c})
    assert keep_one(helpers.empty(spark)).count() == 0


def test_empty(spark):
    assert near_dedup(helpers.empty(spark)).count() == 0
    assert near_dedup(helpers.docs(spark).filter(F.col("doc_id") == 2)).collect()[0][1:] == (0, 2)
