import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from ratewise.operators import popular
from ratewise.operators.recommend import (
    as_arrays, block_counts, classify_users, exclude, recommend, score_pairs, top_k_rows,
)


def factors(spark, ids, dim, seed, ties=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in ids:
        v = rng.integers(-2, 3, dim).astype(float) if ties else rng.normal(size=dim)
        rows.append((int(i), [float(x) for x in v]))
    return spark.createDataFrame(rows, "id int, features array<float>"), {i: np.array(v, dtype=np.float32) for i, v in rows}


def brute_topk(u, v, k):
    out = {}
    ids = sorted(v)
    for uid, uv in u.items():
        scored = [(round(float(np.dot(uv.astype(np.float64), v[i].astype(np.float64))), 9), i) for i in ids]
        scored.sort(key=lambda t: (-t[0], t[1]))
        out[uid] = [i for _, i in scored[:k]]
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_blocked_topk_matches_brute_force(spark, ties):
    uf, u = factors(spark, range(0, 90), 6, 1, ties)
    vf, v = factors(spark, range(1000, 1300), 6, 2, ties)
    # small blocks force several user and item blocks and the cross-block merge
    rows = top_k_rows(uf, vf, 5, user_block_rows=16, item_block_rows=64).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r["rank"])):
        got.setdefault(r.user_id, []).append(r.movie_id)
    assert got == brute_topk(u, v, 5)


def test_block_counts_bounds():
    assert block_counts(0, 0, 8) == (1, 1)
    assert block_counts(30, 10, 1000) == (1, 1)
    assert block_counts(10_000_000, 1_000_000, 2000) == (611, 31)     # size alone fills the cores
    assert block_counts(2_000_000, 2_000_000, 5000) == (123, 62)
    assert block_counts(100_000, 20_000, 64) == (64, 1)               # one item block: users fill them
    assert block_counts(100_000, 100_000, 64) == (16, 4)


def test_score_pairs_drops_unknown(spark):
    uf, u = factors(spark, [1, 2], 4, 5)
    vf, v = factors(spark, [10, 11], 4, 6)
    pairs = spark.createDataFrame([(1, 10), (2, 11), (3, 10), (1, 99)], "user_id int, movie_id int")
    got = {(r.user_id, r.movie_id): r.prediction for r in score_pairs(pairs, uf, vf).collect()}
    assert set(got) == {(1, 10), (2, 11)}
    assert got[(1, 10)] == pytest.approx(float(np.dot(u[1].astype(float), v[10].astype(float))))


def test_exclude_blacklist(spark):
    base = spark.range(1, 11).withColumnRenamed("id", "k")
    bl = spark.range(5, 11).withColumnRenamed("id", "k")
    for how in ("anti", "outer"):
        assert sorted(r.k for r in exclude(base, bl, "k", how).collect()) == [1, 2, 3, 4]


def test_recommend_cold_start(spark):
    uf, _ = factors(spark, [1, 2], 4, 7)
    vf, _ = factors(spark, range(10, 30), 4, 8)
    users = spark.createDataFrame([(1,), (2,), (3,), (3,)], "user_id int")
    ratings = spark.createDataFrame([(1, m) for m in [12, 12, 12, 15, 15, 11]], "user_id int, movie_id int")
    pop = popular.top_items_row(ratings, 2)
    recs = {r.user_id: r for r in recommend(users, uf, vf, 3, "popular", pop).collect()}
    assert set(recs) == {1, 2, 3}
    assert [x.movie_id for x in recs[3].recommendations] == [12, 15] and not recs[3].known
    assert len(recs[1].recommendations) == 3 and recs[1].known
    assert {r.user_id for r in recommend(users, uf, vf, 3, "drop").collect()} == {1, 2}
    with pytest.raises((PySparkException, Py4JJavaError)):
        recommend(users, uf, vf, 3, "fail").collect()


def test_classify_users(spark):
    uf, _ = factors(spark, [1, 2], 4, 7)
    users = spark.createDataFrame([(1,), (3,), (3,)], "user_id int")
    assert sorted(tuple(r) for r in classify_users(users, uf).collect()) == [(1, True), (3, False)]


def test_as_arrays_rank_order(spark):
    rows = spark.createDataFrame([(1, 2, 7, 0.5), (1, 1, 9, 0.9)], "user_id int, rank int, movie_id int, rating double")
    r = as_arrays(rows).first()
    assert [x.movie_id for x in r.recommendations] == [9, 7]


def test_no_known_users_and_no_items(spark):
    uf, _ = factors(spark, [1, 2], 4, 7)
    vf, _ = factors(spark, range(10, 20), 4, 8)
    users = spark.createDataFrame([(5,), (6,)], "user_id int")
    ratings = spark.createDataFrame([(1, 12)], "user_id int, movie_id int")
    recs = recommend(users, uf, vf, 3, "popular", popular.top_items_row(ratings, 3)).collect()
    assert sorted((r.user_id, [x.movie_id for x in r.recommendations], r.known) for r in recs) == [
        (5, [12], False), (6, [12], False)]
    empty_items = vf.limit(0)
    assert top_k_rows(uf, empty_items, 3).count() == 0


def test_pruned_topk_equals_the_full_product(spark):
    """Several tiers, some cut into pieces, ties, zero vectors, users who reach no further than the first tier."""
    import numpy as np

    from ratewise.operators.recommend import top_k_pruned, top_k_rows
    rng = np.random.default_rng(6)
    v = rng.standard_normal((500, 6)) * np.exp(-np.arange(500) / 60)[:, None]
    v[100:160] = v[100] / np.linalg.norm(v[100])     # one length, equal vectors: a tier of ties
    v[490:] = 0
    u = rng.standard_normal((80, 6))
    u[70] = 0
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id int, features array<float>")
    users = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(u)], "id int, features array<float>")
    rows, share = top_k_pruned(users, items, 5, item_block_rows=40)
    key = lambda df: sorted((r.user_id, r["rank"], r.movie_id, round(r.rating, 9)) for r in df.collect())
    assert key(rows) == key(top_k_rows(users, items, 5))
    told = share.orderBy("tier").collect()
    assert sum(r.n_items for r in told) == 500 and told[0].n_users == 80 and len(told) > 5
    assert sum(r.share for r in told) < 0.6           # most of the product is never formed
    assert top_k_pruned(users, items.limit(0), 5)[0].count() == 0
    few, _ = top_k_pruned(users, items.filter("id < 3"), 5, item_block_rows=2)
    assert key(few) == key(top_k_rows(users, items.filter("id < 3"), 5))


@pytest.mark.parametrize("shape", ["lengths", "equal", "copies", "huge"])
def test_block_kernel_is_exact_within_small_memory(shape):
    """The same rows as all scores in double precision, without a block's scores in memory at once."""
    import tracemalloc

    import pandas as pd

    from ratewise.operators.recommend import _block_topk
    rng = np.random.default_rng(11)
    u, v = rng.standard_normal((1500, 10)), rng.standard_normal((6000, 10))
    if shape == "equal":
        v /= np.linalg.norm(v, axis=1)[:, None]
    if shape == "copies":
        v = np.repeat(v[:300], 20, axis=0)
    if shape == "huge":
        u, v = u[:50] * 1e20, v[:400] * 1e20       # products beyond float32
    u, v = u.astype(np.float32), v.astype(np.float32)
    frames = [pd.DataFrame({"id": np.arange(len(x), dtype=np.int32), "features": list(x)}) for x in (u, v)]
    tracemalloc.start()
    got = _block_topk(5)(*frames)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    key = np.round(u.astype(np.float64) @ v.astype(np.float64).T, 9)
    want = np.lexsort((np.broadcast_to(np.arange(len(v)), key.shape), -key), axis=1)[:, :5]
    assert got.movie_id.to_numpy().reshape(-1, 5).tolist() == want.tolist()
    assert got["rank"].tolist() == [1, 2, 3, 4, 5] * len(u)
    assert np.allclose(got.rating, np.take_along_axis(key, want, axis=1).ravel())
    assert peak < 50 << 20


def test_block_kernel_keeps_users_own_bound():
    """A user's k-th score from elsewhere: only items that can still enter come back, ties included."""
    import pandas as pd

    from ratewise.operators.recommend import _block_topk
    users = pd.DataFrame({"id": [1, 2], "features": [np.array([1.0], np.float32)] * 2, "kth": [2.0, np.nan]})
    items = pd.DataFrame({"id": [7, 8, 9], "features": [np.array([x], np.float32) for x in (1.0, 2.0, 3.0)]})
    rows = _block_topk(2)(users, items)
    assert list(zip(rows.user_id, rows["rank"], rows.movie_id)) == [(1, 1, 9), (1, 2, 8), (2, 1, 9), (2, 2, 8)]
    users["kth"] = [2.5, 4.0]
    rows = _block_topk(2)(users, items)
    assert list(zip(rows.user_id, rows.movie_id)) == [(1, 9)]


def test_pruned_topk_sends_a_user_once_to_a_block_of_items(spark):
    """Groups grow with the items' blocks, not with their tiers."""
    from ratewise.operators.recommend import top_k_pruned
    uf, u = factors(spark, range(40), 4, 3)
    vf, v = factors(spark, range(100, 1700), 4, 4)
    rows, share = top_k_pruned(uf, vf, 3, item_block_rows=8)
    assert share.count() <= 65
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in text
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r.user_id, r["rank"])):
        got.setdefault(r.user_id, []).append(r.movie_id)
    assert got == brute_topk(u, v, 3)


def test_arrow_blocks_score_as_pandas_blocks():
    import pandas as pd
    import pyarrow as pa
    from ratewise.operators.recommend import _block_topk, _block_topk_arrow
    rng = np.random.default_rng(3)

    def side(n, first):
        f = rng.normal(size=(n, 6)).astype(np.float32)
        f[n // 2:] = f[:n - n // 2]             # ties
        return pd.DataFrame({"id": np.arange(first, first + n, dtype=np.int32), "features": list(f), "ublk": 0})
    users, items = side(40, 100), side(90, 1000)
    tables = [pa.Table.from_pandas(x, preserve_index=False) for x in (users, items)]
    tables = [pa.concat_tables([t.slice(7), t.slice(0, 7)]) for t in tables]        # several chunks
    got = _block_topk_arrow(5)(*tables).to_pandas().sort_values(["user_id", "rank"]).reset_index(drop=True)
    want = _block_topk(5)(users, items).sort_values(["user_id", "rank"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)
    assert _block_topk_arrow(5)(tables[0], tables[1].slice(0, 0)).num_rows == 0
    ragged = pa.table({"id": pa.array([1, 2], pa.int32()), "features": pa.array([[1.0, 2.0], [1.0]], pa.list_(pa.float32()))})
    with pytest.raises(ValueError):
        _block_topk_arrow(1)(ragged, ragged)


def test_als_blocks_send_few_copies(spark, monkeypatch):
    """Rows shuffled per row of a table of 10-component factors, at 5.4 million users and 7.2 million items."""
    from ratewise.operators import als, recommend
    seen = {}
    real = recommend.block_counts

    def at_size(n_users, n_items, parallelism, user_rows, item_rows):
        seen["blocks"] = real(5_400_000, 7_200_000, 12, user_rows, item_rows)
        return real(n_users, n_items, parallelism, user_rows, item_rows)
    monkeypatch.setattr(recommend, "block_counts", at_size)
    rows = [(u, m, float((u * m) % 5)) for u in range(1, 9) for m in range(1, 7)]
    train = spark.createDataFrame(rows, "user_id int, movie_id int, rating double")
    als.recommend_users(als.fit_als(train, rank=10, max_iter=1, num_blocks=2), train, 5)
    user_blocks, item_blocks = seen["blocks"]
    assert item_blocks <= 5          # users' copies, and k candidates of a user for each
    assert user_blocks <= 16         # items' copies
