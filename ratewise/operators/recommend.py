"""Factor-model scoring and recommendation.

A factor model is two tables ``(id INT, features ARRAY<FLOAT>)``: user factors and item factors
(``ALSModel.userFactors`` / ``itemFactors``, or any table of that shape).

Top-k for many users (J6/O6) is the blocked product ALS itself uses, written with Spark ops:
users are hashed into U blocks and items into I blocks; every (user block, item block) pair is
one cogroup in which numpy multiplies the two factor blocks (BLAS) and keeps the best ``k`` items
per user.  Only ``k`` rows per user and item block leave the task; with I > 1 a window keeps the
best ``k`` of the I*k candidates per user.  Block sizes are bounded, so no group holds a whole
table and no pair table is ever materialised; the shuffle volume is users*I + items*U rows.

Order of recommendations: score descending (compared at 1e-9), then item id ascending.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ratewise.functions.codec import encode_ids, encode_scored
from ratewise.functions.vector import dot
from ratewise.sources.tables import cut_lineage

# Score comparison resolution and default block bounds.
SCORE_DECIMALS = 9
TIE_EPS = 2e-9                 # two scores this close may round to the same 1e-9 step
USER_BLOCK_ROWS = 16384
ITEM_BLOCK_ROWS = 32768
MIN_USER_BLOCK_ROWS = 64
MAX_TIERS = 64                 # lengths told apart when pruning
USER_CHUNK, ITEM_CHUNK = 512, 2048   # users x items scored at once in a task (4 MB of float32)
SCORE_CELLS = USER_CHUNK * ITEM_CHUNK
FLOAT32_SAFE = 1e30            # lengths whose products float32 holds
BROADCAST_MAX_ROWS = 1_000_000  # requested user ids broadcast only below this measured count

TOPK_SCHEMA = "user_id int, movie_id int, rating double, score_key double, rank int"


# ---------------------------------------------------------------- pair scoring

def score_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                user_col: str = "user_id", item_col: str = "movie_id", out_col: str = "prediction") -> DataFrame:
    """Pairs x user factors x item factors -> dot product.

    Pairs whose user or item has no factors are dropped (``coldStartStrategy="drop"``).
    Two equi-joins; adaptive execution broadcasts a factor table only when its measured size is
    under the threshold and splits a skewed user or item (one user with a third of all pairs).
    """
    u = user_factors.select(F.col("id").alias(user_col), F.col("features").alias("_uf"))
    v = item_factors.select(F.col("id").alias(item_col), F.col("features").alias("_vf"))
    return (pairs.join(u, user_col).join(v, item_col)
            .withColumn(out_col, dot("_uf", "_vf")).drop("_uf", "_vf"))


# ---------------------------------------------------------------- blocked top-k

def _every_score(u: np.ndarray, v: np.ndarray, item_ids: np.ndarray, k: int):
    """Each user's ``k`` best by every score in double precision: vectors float32 cannot hold (NaN,
    infinite, huge), which numpy sorts last, that is best."""
    n, kk = len(item_ids), min(k, len(item_ids))
    u, v = u.astype(np.float64), v.astype(np.float64)
    chunk = max(1, SCORE_CELLS // n)
    out_i, out_s, out_key = [], [], []
    for start in range(0, len(u), chunk):
        raw = u[start:start + chunk] @ v.T
        rows = np.arange(len(raw))[:, None]
        cand = np.argpartition(raw, n - kk, axis=1)[:, n - kk:]
        kth = raw[rows, cand].min(axis=1)
        near = (raw >= (kth - TIE_EPS)[:, None]).sum(axis=1)
        for r in np.nonzero(near > kk)[0]:
            idx = np.nonzero(raw[r] >= kth[r] - TIE_EPS)[0]
            cand[r] = idx[np.lexsort((item_ids[idx], -np.round(raw[r, idx], SCORE_DECIMALS)))[:kk]]
        ck = np.round(raw[rows, cand], SCORE_DECIMALS)
        order = np.lexsort((item_ids[cand], -ck), axis=1)
        best = np.take_along_axis(cand, order, axis=1)
        out_i.append(item_ids[best])
        out_s.append(raw[rows, best])
        out_key.append(np.take_along_axis(ck, order, axis=1))
    return np.concatenate(out_i), np.concatenate(out_s), np.concatenate(out_key), np.ones((len(u), kk), dtype=bool)


def _best_items(u: np.ndarray, v: np.ndarray, item_ids: np.ndarray, k: int, kth: np.ndarray):
    """Each user's ``k`` best items of a block: ids, scores and score keys (users x k), and which of them exist.

    Items come longest first, a user leaves when |user| * |item| falls below the k-th score so far
    (``kth``: the one it brings along).  A chunk of users meets a chunk of items in float32; only
    pairs that could reach the k-th score, with twice float32's rounding error as a margin, are
    scored in double precision.  So memory is a chunk's, whatever the block's size."""
    dim = u.shape[1]
    lu, lv = (np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)) for x in (u, v))
    if not lu.max() * lv.max() < FLOAT32_SAFE or max(lu.max(), lv.max()) > FLOAT32_SAFE:      # NaN as well
        return _every_score(u, v, item_ids, k)
    order = np.lexsort((item_ids, -lv))
    v, lv, item_ids = v[order], lv[order], item_ids[order]
    v32 = v.astype(np.float32, copy=False)
    error = (dim + 4) * 2.0 ** -23
    ids = np.zeros((len(u), k), dtype=np.int64)
    scores, keys = np.zeros((len(u), k)), np.full((len(u), k), -np.inf)
    floor = kth - TIE_EPS
    for start in range(0, len(u), USER_CHUNK):
        end = min(len(u), start + USER_CHUNK)
        for at in range(0, len(v), ITEM_CHUNK):
            reach = lu[start:end] * lv[at] * (1 + 1e-9) + TIE_EPS
            rows = start + np.nonzero(reach >= floor[start:end])[0]
            if not len(rows):
                break
            raw = u[rows].astype(np.float32, copy=False) @ v32[at:at + ITEM_CHUNK].T
            slack = error * lu[rows] * lv[at]
            low = floor[rows] - slack
            free = np.isneginf(low)                  # fewer than k so far: this chunk's own k-th bounds them
            if free.any() and raw.shape[1] > k:
                own = np.partition(raw[free], raw.shape[1] - k, axis=1)[:, raw.shape[1] - k]
                low[free] = own - 2 * slack[free] - TIE_EPS
            low = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
            r, c = np.divmod(np.flatnonzero(raw >= low[:, None]), raw.shape[1])      # flat: far faster than by two axes
            r, c = rows[r], at + c
            score = np.empty(len(r))
            step = max(1, SCORE_CELLS // dim)
            for i in range(0, len(r), step):
                score[i:i + step] = np.einsum("ij,ij->i", u[r[i:i + step]], v[c[i:i + step]], dtype=np.float64)
            key = np.round(score, SCORE_DECIMALS) + 0.0
            good = key >= floor[r]
            r, c, score, key = r[good], c[good], score[good], key[good]
            if not len(r):
                continue
            # the best so far and the new ones of the users met, in order, k of each
            met = np.unique(r)
            who = np.concatenate([np.repeat(met, k), r])
            what = np.concatenate([ids[met].ravel(), item_ids[c]])
            by = np.concatenate([keys[met].ravel(), key])
            value = np.concatenate([scores[met].ravel(), score])
            ranked = np.lexsort((what, -by, who))
            first = np.searchsorted(who[ranked], met)
            ranked = ranked[first[:, None] + np.arange(k)]
            ids[met], keys[met], scores[met] = what[ranked], by[ranked], value[ranked]
            floor[met] = np.maximum(floor[met], keys[met, k - 1] - TIE_EPS)
    return ids, scores, keys, ~np.isneginf(keys)


def _ranked(user_ids: np.ndarray, u: np.ndarray, kth: np.ndarray, item_ids: np.ndarray, v: np.ndarray, k: int) -> dict:
    """The columns of ``TOPK_SCHEMA`` for a block of users and one of items."""
    ids, scores, keys, real = _best_items(u, v, item_ids.astype(np.int64), k, kth)
    row, at = np.nonzero(real)
    return {"user_id": user_ids[row].astype(np.int32), "movie_id": ids[row, at].astype(np.int32),
            "rating": scores[row, at], "score_key": keys[row, at], "rank": (at + 1).astype(np.int32)}


def _block_topk(k: int):
    """The cogrouped function: a block of users (``kth``: the k-th score each brings along, if it does) and one of items."""
    def run(users: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        if users.empty or items.empty or k < 1:
            return pd.DataFrame({"user_id": pd.Series([], dtype="int32"), "movie_id": pd.Series([], dtype="int32"),
                                 "rating": pd.Series([], dtype="float64"), "score_key": pd.Series([], dtype="float64"),
                                 "rank": pd.Series([], dtype="int32")})
        kth = users["kth"].fillna(-np.inf).to_numpy(dtype=np.float64) if "kth" in users else np.full(len(users), -np.inf)
        return pd.DataFrame(_ranked(users["id"].to_numpy(), np.stack(users["features"].to_numpy()), kth,
                                    items["id"].to_numpy(), np.stack(items["features"].to_numpy()), k))
    return run


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as one matrix, without an object for each row."""
    vectors = vectors.combine_chunks()
    length = pc.min_max(pc.list_value_length(vectors)).as_py()
    if vectors.null_count or length["min"] != length["max"]:
        return np.stack(vectors.to_pandas().to_numpy())         # fails, and says so
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), length["min"])


def _block_topk_arrow(k: int):
    """``_block_topk`` on Arrow tables: a row is its numbers alone, so blocks may be larger."""
    schema = pa.schema([("user_id", pa.int32()), ("movie_id", pa.int32()), ("rating", pa.float64()),
                        ("score_key", pa.float64()), ("rank", pa.int32())])

    def run(users: pa.Table, items: pa.Table) -> pa.Table:
        if not users.num_rows or not items.num_rows or k < 1:
            return schema.empty_table()
        return pa.table(_ranked(users["id"].to_numpy(), _matrix(users["features"]), np.full(users.num_rows, -np.inf),
                                items["id"].to_numpy(), _matrix(items["features"]), k), schema=schema)
    return run


def block_counts(n_users: int, n_items: int, parallelism: int,
                 user_block_rows: int = USER_BLOCK_ROWS, item_block_rows: int = ITEM_BLOCK_ROWS):
    """(U, I): blocks bounded in size, and U * I tasks for the cluster's cores.

    Every user block is sent all items, so U grows beyond its size bound only until U * I covers
    the cores."""
    n_ib = max(1, math.ceil(n_items / item_block_rows))
    u_by_par = min(math.ceil(parallelism / n_ib), math.ceil(n_users / MIN_USER_BLOCK_ROWS))
    return max(1, math.ceil(n_users / user_block_rows), u_by_par), n_ib


def top_k_rows(user_factors: DataFrame, item_factors: DataFrame, k: int = 5,
               user_block_rows: int = USER_BLOCK_ROWS, item_block_rows: int = ITEM_BLOCK_ROWS,
               n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """``(user_id, rank, movie_id, rating)`` -- the ``k`` best items of every user.

    Includes items the user already rated (as the reference's ``recommendProducts``).
    ``n_users`` / ``n_items`` size the blocks; when not given they are counted (two small jobs).
    """
    spark = user_factors.sparkSession
    n_users = user_factors.count() if n_users is None else n_users
    n_items = item_factors.count() if n_items is None else n_items
    n_ub, n_ib = block_counts(n_users, n_items, spark.sparkContext.defaultParallelism,
                              user_block_rows, item_block_rows)

    def blocks(ids, n):
        return F.pmod(F.xxhash64(ids), F.lit(n)).cast("int")

    users = user_factors.select("id", "features", blocks("id", n_ub).alias("ublk"))
    users = users.withColumn("iblk", F.explode(F.sequence(F.lit(0), F.lit(n_ib - 1))) if n_ib > 1 else F.lit(0))
    items = item_factors.select("id", "features", blocks("id", n_ib).alias("iblk"))
    items = items.withColumn("ublk", F.explode(F.sequence(F.lit(0), F.lit(n_ub - 1))) if n_ub > 1 else F.lit(0))

    pairs = users.groupBy("ublk", "iblk").cogroup(items.groupBy("ublk", "iblk"))
    if user_block_rows > USER_BLOCK_ROWS or item_block_rows > ITEM_BLOCK_ROWS:     # too large for an object a row
        cand = pairs.applyInArrow(_block_topk_arrow(k), TOPK_SCHEMA)
    else:
        cand = pairs.applyInPandas(_block_topk(k), TOPK_SCHEMA)
    if n_ib > 1:
        w = Window.partitionBy("user_id").orderBy(F.desc("score_key"), F.asc("movie_id"))
        cand = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return cand.select("user_id", "rank", "movie_id", "rating")


def _norm(features: str) -> Column:
    return F.sqrt(F.aggregate(F.transform(features, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x))


def top_k_pruned(user_factors: DataFrame, item_factors: DataFrame, k: int = 5, user_block_rows: int = USER_BLOCK_ROWS,
                 item_block_rows: int = ITEM_BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """J6/O6 with exact pruning: the rows of ``top_k_rows``, and how much of the product was scored.

    Items are dealt into tiers by the length of their vectors, longest first.  Every user meets the
    first tier; its k-th best score there bounds what can still enter: by Cauchy-Schwarz an item
    scores at most |user| * |item|, so a user is sent only to those other tiers whose longest vector
    can reach that score.  Tiers larger than a block (many equal lengths) are cut into pieces by hash.
    The tier limits are one array, the tiers' sizes and lengths one row per tier.

    The second frame has a row per tier: ``tier, n_items, longest, n_users`` (users sent), ``share`` (of
    all user-item cells that this tier's scoring is)."""
    spark = user_factors.sparkSession
    # written with their lengths: in the comparisons below a length would be worked out again for each tier
    items = cut_lineage(item_factors.select("id", "features", _norm("features").alias("_len")))
    users = user_factors.select("id", "features", _norm("features").alias("_len"))
    n_items, n_users = items.count(), user_factors.count()
    n_tiers = min(MAX_TIERS, max(1, math.ceil(n_items / item_block_rows)))
    limits = [] if n_tiers == 1 else items.agg(F.percentile_approx(
        "_len", [1 - t / n_tiers for t in range(1, n_tiers)], 10_000)).first()[0] or []
    limits = sorted(set(limits), reverse=True)
    # the tier of a length: how many limits lie above it
    tier = F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x > F.col("_len"))) if limits else F.lit(0)
    items = items.withColumn("tier", tier)
    facts = sorted(items.groupBy("tier").agg(F.count(F.lit(1)), F.max("_len")).collect())     # one row a tier
    if not facts:
        return top_k_rows(user_factors, item_factors, k, n_users=n_users, n_items=0), spark.createDataFrame(
            [], "tier int, n_items bigint, longest double, n_users bigint, share double")
    # neighbouring tiers share a block of items while it stays bounded; a larger tier is cut into pieces by hash
    first_tier, blocks, block_of = facts[0][0], [], {}
    for t, n, longest in facts:
        if len(blocks) < 2 or blocks[-1][1] + n > ITEM_BLOCK_ROWS:      # the first tier is a block of its own
            blocks.append([longest, 0])
        blocks[-1][1] += n
        block_of[t] = len(blocks) - 1
    n_ub, _ = block_counts(n_users, n_items, spark.sparkContext.defaultParallelism, user_block_rows, ITEM_BLOCK_ROWS)
    piece_of = F.element_at(F.array(*[F.lit(max(1, math.ceil(n / ITEM_BLOCK_ROWS))) for _, n in blocks]), F.col("blk") + 1)
    block = F.element_at(F.create_map(*[F.lit(x) for pair in block_of.items() for x in pair]), F.col("tier"))
    items = items.withColumn("blk", block).withColumn("piece", F.pmod(F.xxhash64("id"), piece_of).cast("int")).withColumn(
        "ublk", F.explode(F.sequence(F.lit(0), F.lit(n_ub - 1))))
    users = users.withColumn("ublk", F.pmod(F.xxhash64("id"), F.lit(n_ub)).cast("int"))
    by = ["ublk", "blk", "piece"]

    def best(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("user_id").orderBy(F.desc("score_key"), F.asc("movie_id"))
        return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    def product(sent: DataFrame, of: DataFrame) -> DataFrame:
        sent = sent.withColumn("piece", F.explode(F.sequence(F.lit(0), piece_of - 1)))
        return (sent.select("id", "features", "kth", *by).groupBy(*by).cogroup(of.select("id", "features", *by).groupBy(*by))
                .applyInPandas(_block_topk(k), TOPK_SCHEMA))

    first = cut_lineage(best(product(users.withColumn("blk", F.lit(0)).withColumn("kth", F.lit(None).cast("double")),
                                     items.filter(F.col("blk") == 0))))
    kth = first.groupBy(F.col("user_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score_key")).alias("kth"))

    def within(longest: Column) -> Column:
        return F.col("kth").isNull() | (F.col("_len") * longest * (1 + 1e-9) + TIE_EPS >= F.col("kth"))

    # a user goes once to each block of items that it reaches, with its k-th score, and leaves there by itself
    reach = F.array(*[F.struct(F.lit(i).alias("blk"), F.lit(longest).alias("longest")) for i, (longest, _) in enumerate(blocks) if i]) \
        if len(blocks) > 1 else F.array().cast("array<struct<blk:int,longest:double>>")
    met = cut_lineage(users.join(kth, "id", "left"))
    sent = met.withColumn("blk", F.explode(F.filter(reach, lambda b: within(b["longest"])))).select("id", "features", "kth", "ublk", "blk.blk")
    rows = best(first.unionByName(product(sent, items.filter(F.col("blk") != 0)))).select("user_id", "rank", "movie_id", "rating")
    lengths = F.array(*[F.struct(F.lit(t).alias("tier"), F.lit(longest).alias("longest")) for t, _, longest in facts])
    sent = met.select(F.explode(F.filter(lengths, lambda t: within(t["longest"]))).alias("t")).select("t.tier")
    told = spark.createDataFrame([(t, n, float(longest)) for t, n, longest in facts], "tier int, n_items bigint, longest double")
    share = told.join(sent.groupBy("tier").agg(F.count(F.lit(1)).alias("_sent")), "tier", "left").withColumn(
        "n_users", F.when(F.col("tier") == first_tier, F.lit(n_users)).otherwise(F.coalesce("_sent", F.lit(0))).cast("bigint")).select(
        "tier", "n_items", "longest", "n_users", (F.col("n_users") * F.col("n_items") / F.lit(max(1, n_users * n_items))).alias("share"))
    return rows, share


def as_arrays(rows: DataFrame) -> DataFrame:
    """Top-k rows -> ``(user_id, recommendations array<struct<movie_id, rating>>)`` in rank order.
    Each user's group holds at most k rows."""
    agg = rows.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "movie_id", "rating"))).alias("_r"))
    return agg.select("user_id", F.transform("_r", lambda r: F.struct(
        r["movie_id"].alias("movie_id"), r["rating"].alias("rating"))).alias("recommendations"))


# ---------------------------------------------------------------- users known / unknown

def classify_users(users: DataFrame, known_ids: DataFrame, user_col: str = "user_id",
                   id_col: str = "id", n_users: int | None = None) -> DataFrame:
    """One row per requested user with ``known`` -- no job per user.

    The known table (all users with factors, possibly huge) is cut to the requested users by a
    semi join whose build side is the requested set.  When the caller has counted the requested
    users (``n_users``) and they fit under ``BROADCAST_MAX_ROWS``, that side is broadcast and the
    big table is only scanned; otherwise both sides are shuffled on the user id.
    """
    wanted = users.select(user_col).distinct()
    small = n_users is not None and n_users <= BROADCAST_MAX_ROWS
    hits = (known_ids.select(F.col(id_col).alias(user_col))
            .join(F.broadcast(wanted) if small else wanted, user_col, "left_semi")
            .distinct().withColumn("_hit", F.lit(True)))
    return (wanted.join(F.broadcast(hits) if small else hits, user_col, "left")
            .select(user_col, F.coalesce("_hit", F.lit(False)).alias("known")))


def exclude(df: DataFrame, blacklist: DataFrame, key: str, how: str = "anti") -> DataFrame:
    """Rows of ``df`` whose key is not in ``blacklist``.

    ``how="anti"`` is a left anti join; ``how="outer"`` is the reference's form (right outer
    join from the blacklist, keep rows with no blacklist match).
    """
    bl = blacklist.select(F.col(key)).distinct()
    if how == "anti":
        return df.join(bl, key, "left_anti")
    if how == "outer":
        marked = bl.withColumn("_bl", F.lit(True))
        return marked.join(df, key, "right_outer").filter(F.col("_bl").isNull()).drop("_bl")
    raise ValueError("how must be 'anti' or 'outer'")


# ---------------------------------------------------------------- recommend with cold start

COLD_START = ("popular", "drop", "fail")


def _written(df: DataFrame, count) -> tuple[DataFrame, int]:
    """The rows in the checkpoint folder, and a count that the writing pass observes."""
    seen = Observation()
    return cut_lineage(df.observe(seen, count.alias("n"))), seen.get["n"]


def recommend(users: DataFrame, user_factors: DataFrame, item_factors: DataFrame, k: int = 5,
              cold_start: str = "popular", popular: DataFrame | None = None,
              user_col: str = "user_id", n_items: int | None = None, n_users: int | None = None) -> DataFrame:
    """Top-k per requested user: ``(user_id, recommendations, known)``.

    cold_start
      ``popular``  unknown users get the ``popular`` ids (one-row frame ``popular: array<int>``,
                   read once as a scalar subquery -- the broadcast side value of the reference);
      ``drop``     unknown users give no row;
      ``fail``     the job fails on the first unknown user (the reference's model call).

    ``n_users``: the caller passes distinct, already materialised users and their count
    (a stream batch does); otherwise they are de-duplicated, checkpointed and counted here.
    """
    if cold_start not in COLD_START:
        raise ValueError(f"cold_start must be one of {COLD_START}")
    # the requested users are written once to the shared checkpoint folder and counted there;
    # the count decides the join strategy, and both branches (known, unknown) and the block
    # sizing read the classified users instead of recomputing the users' plan
    if n_users is None:
        requested, n_users = _written(users.select(user_col).distinct(), F.count(F.lit(1)))
    else:
        requested = users.select(user_col)
    wanted, n_known = _written(classify_users(requested, user_factors, user_col, n_users=n_users), F.count_if("known"))
    known_ids = wanted.filter("known").select(F.col(user_col).alias("id"))
    small = n_known <= BROADCAST_MAX_ROWS
    known_f = user_factors.join(F.broadcast(known_ids) if small else known_ids, "id", "left_semi")
    rows = top_k_rows(known_f, item_factors, k, n_users=n_known, n_items=n_items)
    recs = as_arrays(rows).withColumnRenamed("user_id", user_col)
    recs = recs.withColumn("known", F.lit(True))
    if cold_start == "drop":
        return recs
    unknown = wanted.filter(~F.col("known")).select(user_col)
    if cold_start == "fail":
        failing = unknown.select(
            F.col(user_col),
            F.raise_error(F.concat(F.lit("user has no factors: "), F.col(user_col).cast("string")))
            .cast(recs.schema["recommendations"].dataType).alias("recommendations"),
            F.lit(False).alias("known"))
        return recs.unionByName(failing)
    if popular is None:
        raise ValueError("cold_start='popular' needs the popular frame")
    pop = popular.select(F.transform("popular", lambda i: F.struct(
        i.cast("int").alias("movie_id"), F.lit(None).cast("double").alias("rating"))).alias("p"))
    fallback = unknown.select(user_col, pop.scalar().alias("recommendations"), F.lit(False).alias("known"))
    return recs.unionByName(fallback)


def encoded(recs: DataFrame, how: str = "ids", scale: int | None = None, user_col: str = "user_id") -> DataFrame:
    """P12/P13 projection of recommendations to ``(user_id, res)``."""
    if how == "ids":
        res = encode_ids("recommendations")
    elif how == "scored":
        res = encode_scored("recommendations", scale)
    else:
        raise ValueError("how must be 'ids' or 'scored'")
    return recs.select(user_col, res.alias("res"))
