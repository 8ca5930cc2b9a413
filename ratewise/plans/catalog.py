"""Registered queries: one per operator group of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole benchmark tables (through ``views``) and returns the rows the
matching SQL in ``oracle.py`` returns.  Computed columns carry the same names in both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.functions.codec import decode_user, encode_ids, encode_message, pair_key
from ratewise.functions.vector import dot, truncate
from ratewise.operators import parse, popular, split
from ratewise.operators.metrics import best_by, match_truth, regression_metrics, rmse_fixed
from ratewise.operators.recommend import (
    as_arrays, classify_users, encoded, exclude, recommend, score_pairs, top_k_pruned, top_k_rows,
)
from ratewise.operators.upsert import UserTable, apply_actions, classify
from ratewise.plans import views as V
from ratewise.session import scratch_path
from ratewise.sources.tables import cut_lineage, read_table, save_table, stored

K = 5                    # items per recommendation (the reference's recommendNum)
TRAIN_FRACTION = 0.6     # sorted split
HASH_TRAIN_WEIGHT = 0.8  # repeatable split
RATING_THRESHOLD = 2.5   # P14 predicate
ONE_USER = 1             # P15 predicate
SCORE_DIGITS = 6         # printed / compared score precision
GRID_RANKS = (16, 32, 48, 64)
PRUNED_BLOCK_ROWS = 64   # items in a tier, so that small tables have several

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- counts, popularity, splits

def q_popular_items(spark, d):
    return popular.top_items(V.ratings(spark, d), K)


def q_row_counts(spark, d):
    return popular.row_counts(V.ratings(spark, d), (TRAIN_FRACTION,))


def q_distinct_users(spark, d):
    return popular.distinct_users(V.ratings(spark, d))


def q_filter_rows(spark, d):
    return popular.filter_counts(V.ratings(spark, d), RATING_THRESHOLD, ONE_USER)


def _split(spark, d):
    """The ratings are derived once and written: selection and each side read the table."""
    return split.sorted_fraction_split(stored(V.ratings(spark, d), "ratings"), TRAIN_FRACTION)


def q_split_train(spark, d):
    return _split(spark, d)[0]


def q_split_test(spark, d):
    return _split(spark, d)[1]


def q_split_hash(spark, d):
    r = V.ratings(spark, d)
    train, test = split.hash_split(r, ("user_id", "movie_id"), HASH_TRAIN_WEIGHT)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# ---------------------------------------------------------------- joins, scoring, metrics

def q_anti_blacklist(spark, d):
    users = V.messages(spark, d).select(decode_user("value").alias("user_id")).distinct()
    blacklist = V.user_factors(spark, d).select(F.col("id").alias("user_id"))
    return exclude(users, blacklist, "user_id", "anti")


def q_classify_users(spark, d):
    users = V.messages(spark, d).select(decode_user("value").alias("user_id"))
    return classify_users(users, V.user_factors(spark, d))


def q_score_pairs(spark, d):
    pred = score_pairs(V.ratings(spark, d), V.user_factors(spark, d), V.item_factors(spark, d))
    return pred.withColumn("prediction", F.round("prediction", SCORE_DIGITS))


def _held_out_metrics(spark, d):
    r = cut_lineage(V.ratings(spark, d))    # read by the selection, as pairs to score and as truth
    _, test = split.sorted_fraction_split(r, TRAIN_FRACTION)
    pred = score_pairs(test.select("user_id", "movie_id"), V.user_factors(spark, d), V.item_factors(spark, d))
    return r, test, match_truth(pred, test)


def q_rmse_fixed(spark, d):
    r, _, matched = _held_out_metrics(spark, d)
    n_test = r.agg(F.floor(F.count(F.lit(1)) * F.lit(1 - TRAIN_FRACTION)).alias("n")).scalar()
    return rmse_fixed(matched, n_test).select(F.round("rmse_fixed", SCORE_DIGITS).alias("rmse_fixed"))


def q_rmse_matched(spark, d):
    _, _, matched = _held_out_metrics(spark, d)
    return regression_metrics(matched, digits=SCORE_DIGITS).select("n_matched", "rmse")


def q_metrics_all(spark, d):
    _, _, matched = _held_out_metrics(spark, d)
    return regression_metrics(matched, digits=SCORE_DIGITS).select("n_matched", "rmse", "mse", "mae", "r2")


def q_best_params(spark, d):
    """A9 over a grid of candidate models (M4/M5 shape): the factor model truncated to each rank."""
    _, test = _split(spark, d)
    u = V.user_factors(spark, d).select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    v = V.item_factors(spark, d).select(F.col("id").alias("movie_id"), F.col("features").alias("v"))
    # every pair meets its factors once and is scored for all candidates there
    errors = F.array(*[F.struct(F.lit(cand).alias("candidate"), F.lit(rank).alias("rank"),
                                (dot(truncate("u", rank), truncate("v", rank)) - F.col("rating")).alias("e"))
                       for cand, rank in enumerate(GRID_RANKS)])
    scored = test.join(u, "user_id").join(v, "movie_id").select(F.explode(errors).alias("s")).select("s.*")
    metrics = scored.groupBy("candidate", "rank").agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))
    best = best_by(metrics, "rmse", "candidate")
    return best.select("candidate", "rank", F.round("rmse", SCORE_DIGITS).alias("rmse"))


# ---------------------------------------------------------------- parsing

def q_parse_links(spark, d):
    return parse.parse_links(V.links_lines(spark, d))


def q_parse_movies(spark, d):
    return parse.parse_movies(V.movies_lines(spark, d))


def q_parse_tags(spark, d):
    return parse.parse_tags(V.tags_lines(spark, d))


def q_parse_ratings(spark, d):
    return parse.parse_ratings(V.ratings_lines(spark, d))


def q_parse_dcolon(spark, d):
    return parse.parse_dcolon(V.dcolon_lines(spark, d))


def q_text_scan(spark, d):
    """S1 + P2: the movie lines written as a text file, scanned back with a minimum partition count."""
    from ratewise.sources.text import read_lines
    path = scratch_path(spark, "text/movies")
    V.movies_lines(spark, d).write.mode("overwrite").text(path)
    return parse.parse_movies(read_lines(spark, path, spark.sparkContext.defaultParallelism))


def q_parse_rejects(spark, d):
    _, rejects = parse.parse_ratings(V.bad_lines(spark, d), parse.PERMISSIVE)
    return rejects


# ---------------------------------------------------------------- encoders

def q_encode_message(spark, d):
    train, _ = _split(spark, d)
    key, value = encode_message("user_id", "movie_id", "rating")
    return train.select(key, value, pair_key("user_id", "movie_id").alias("pair_key"))


def q_decode_users(spark, d):
    return V.messages(spark, d).select(decode_user("value").alias("user_id")).distinct()


def _factor_topk(spark, d):
    return top_k_rows(V.user_factors(spark, d), V.item_factors(spark, d), K)


def q_topk_factors(spark, d):
    return _factor_topk(spark, d).withColumn("rating", F.round("rating", SCORE_DIGITS))


def q_topk_pruned(spark, d):
    """J6/O6 with items in tiers by length; a user skips the tiers that cannot reach its k-th score."""
    rows, _ = top_k_pruned(V.user_factors(spark, d), V.item_factors(spark, d), K, item_block_rows=PRUNED_BLOCK_ROWS)
    return rows.withColumn("rating", F.round("rating", SCORE_DIGITS))


def q_encode_ids(spark, d):
    return encoded(as_arrays(_factor_topk(spark, d)), "ids")


def q_encode_scored(spark, d):
    return encoded(as_arrays(_factor_topk(spark, d)), "scored", SCORE_DIGITS)


# ---------------------------------------------------------------- recommendation with cold start, upsert

def _recommend_ids(spark, d, users, ratings=None):
    ratings = V.ratings(spark, d) if ratings is None else ratings
    recs = recommend(users, V.user_factors(spark, d), V.item_factors(spark, d), K, "popular",
                     popular.top_items_row(ratings, K))
    return recs.select("user_id", encode_ids("recommendations").alias("res"), "known")


def q_recommend_cold_start(spark, d):
    # ratings feed both the user list and the popular list: derived once, read twice
    ratings = cut_lineage(V.ratings(spark, d))
    return _recommend_ids(spark, d, popular.distinct_users(ratings), ratings)


def _incoming(spark, d):
    users = V.messages(spark, d).select(decode_user("value").alias("user_id")).distinct()
    return _recommend_ids(spark, d, users).select("user_id", "res")


def q_upsert_actions(spark, d):
    return classify(_incoming(spark, d), V.rec_user(spark, d), V.TODAY)


def q_upsert_result(spark, d):
    target = V.rec_user(spark, d)
    return apply_actions(target, classify(_incoming(spark, d), target, V.TODAY))


# ---------------------------------------------------------------- tables

def q_table_roundtrip(spark, d):
    name = "ratewise_ratings"
    save_table(q_parse_ratings(spark, d), name, mode="overwrite", fmt="parquet", replace=True,
               path=scratch_path(spark, "tables/ratewise_ratings"))
    return read_table(spark, name, ["user_id", "movie_id", "rating", "timeStamp"])


# ---------------------------------------------------------------- streaming

def _events_stream(spark, d):
    from ratewise.streaming.job import file_stream
    schema = V.table(spark, d, "events").schema
    return V.message_frame(file_stream(spark, d, "events.parquet", schema, max_files_per_trigger=1))


def q_stream_distinct_users(spark, d):
    from ratewise.streaming.job import distinct_users_per_batch
    out = scratch_path(spark, "stream-users")
    q = distinct_users_per_batch(_events_stream(spark, d), out, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).select(F.col("batch_id").cast("bigint"), "user_id")


def _popular_ids(spark, d):
    """Loaded once per application, whatever the number of queries it starts; all ratings are read for it."""
    return cut_lineage(popular.top_items_row(V.ratings(spark, d), K))


def _recommend_batch(spark, d, store, pop, **options):
    from ratewise.streaming.job import RecommendBatch
    return RecommendBatch(V.user_factors(spark, d), V.item_factors(spark, d), pop, store, K, "popular", V.TODAY, **options)


def _run_recommend_stream(spark, d, runs: int):
    from ratewise.streaming.job import start
    store = UserTable(spark, scratch_path(spark, "rec-user")).init(V.rec_user(spark, d))
    fn = _recommend_batch(spark, d, store, _popular_ids(spark, d))
    for _ in range(runs):
        # a replay: a fresh checkpoint re-reads the same input as batch 0 again
        q = start(_events_stream(spark, d), fn, scratch_path(spark, "rec-ckpt"), available_now=True)
        q.awaitTermination()
    return store.state()


def q_stream_recommend(spark, d):
    return _run_recommend_stream(spark, d, 1)


def q_stream_replay(spark, d):
    return _run_recommend_stream(spark, d, 2)


EVENT_FILES = 3


def _event_halves(spark, d):
    """The events before and from their mean time; events without a time come second."""
    e = V.table(spark, d, "events").select("event_id", "user_id", "value", "ts")
    early = F.coalesce(F.col("ts").cast("timestamp").cast("double") < e.agg(F.avg(F.col("ts").cast("timestamp").cast("double"))).scalar(), F.lit(False))
    return [e.filter(early).drop("ts"), e.filter(~early).drop("ts")]


def _add_files(events, path: str, by: str = "event_id") -> None:
    events.repartition(EVENT_FILES, by).write.mode("append").parquet(path)


def _files_stream(spark, path: str):
    """One file a batch."""
    from ratewise.streaming.job import file_stream
    return V.message_frame(file_stream(spark, path, "*.parquet", "event_id bigint, user_id bigint, value double"))


def q_stream_restart(spark, d):
    """Half of the files, then a new query object goes on from the same checkpoint."""
    from ratewise.streaming.job import start
    files, ckpt = scratch_path(spark, "events"), scratch_path(spark, "rec-ckpt")
    store = UserTable(spark, scratch_path(spark, "rec-user")).init(V.rec_user(spark, d))
    pop = _popular_ids(spark, d)
    for half in _event_halves(spark, d):
        _add_files(half, files)
        fn = _recommend_batch(spark, d, store, pop, run=ckpt)
        start(_files_stream(spark, files), fn, ckpt, available_now=True).awaitTermination()
    return store.state()


def q_stream_failed_batch(spark, d):
    """The second batch fails after its store write; the restarted query replays it."""
    from pyspark.errors import StreamingQueryException

    from ratewise.streaming.job import start

    def fail(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost after the write")

    files, ckpt = scratch_path(spark, "events"), scratch_path(spark, "rec-ckpt")
    store = UserTable(spark, scratch_path(spark, "rec-user")).init(V.rec_user(spark, d))
    for half in _event_halves(spark, d):
        _add_files(half, files)
    pop = _popular_ids(spark, d)
    try:
        start(_files_stream(spark, files), _recommend_batch(spark, d, store, pop, run=ckpt, sink=fail), ckpt,
              available_now=True).awaitTermination()
    except StreamingQueryException:
        pass        # the failure asked for
    start(_files_stream(spark, files), _recommend_batch(spark, d, store, pop, run=ckpt), ckpt, available_now=True).awaitTermination()
    return store.state()


def q_stream_model_only(spark, d):
    """T5: no store and no popular list.  A stream of all messages fails on the first user without
    factors, before anything of that batch is put out; a stream of the known users' messages gives
    the model's ids, once per half (a user's messages of a half lie in one file, one batch)."""
    from pyspark.errors import StreamingQueryException

    from ratewise.streaming.job import RecommendBatch, start
    files, out = scratch_path(spark, "events"), scratch_path(spark, "recs")
    for half in _event_halves(spark, d):
        _add_files(half, files, "user_id")
    users, items = V.user_factors(spark, d), V.item_factors(spark, d)

    def write(recs, batch_id, to=out):
        (recs.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(to))

    every = scratch_path(spark, "recs-all")
    fn = RecommendBatch(users, items, None, None, K, "fail", sink=lambda recs, i: write(recs, i, every))
    failed = False
    try:
        start(_files_stream(spark, files), fn, scratch_path(spark, "all-ckpt"), available_now=True).awaitTermination()
    except StreamingQueryException as e:
        failed = "user has no factors" in str(e)

    known = _files_stream(spark, files).join(
        users.select(F.col("id").alias("_known")), F.split("value", "_")[0].cast("int") == F.col("_known"), "left_semi")
    fn = RecommendBatch(users, items, None, None, K, "fail", sink=write)
    start(known, fn, scratch_path(spark, "rec-ckpt"), available_now=True).awaitTermination()
    return spark.read.parquet(out).select("user_id", "res", F.lit(failed).alias("all_users_fail"))


def q_stream_offsets(spark, d):
    """Source offsets of every batch, over a restart; a second reader resumes from the table."""
    from ratewise.streaming.offsets import OffsetLog
    from ratewise.streaming.job import start
    files, ckpt, path = (scratch_path(spark, n) for n in ("events", "offset-ckpt", "offsets"))
    for half in _event_halves(spark, d):
        _add_files(half, files)
        with OffsetLog(spark, path, run=ckpt) as log:
            log.follow(start(_files_stream(spark, files), lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save(),
                             ckpt, available_now=True))
    offsets = log.table()
    at = F.get_json_object("end_offset", "$.logOffset").cast("long")
    since = F.get_json_object("start_offset", "$.logOffset").cast("long")
    return offsets.select("batch_id", F.coalesce(since, F.lit(-1)).alias("starts_after"), at.alias("ends_at"),
                          F.sum("n_rows").over(Window.partitionBy("run")).alias("n_messages"))


def q_stream_counts(spark, d):
    """Rows counted per batch, over a restart; one row with their sum and the batch count."""
    from ratewise.streaming.job import batch_counts, start
    files, ckpt, counts = (scratch_path(spark, n) for n in ("events", "count-ckpt", "counts"))
    for half in _event_halves(spark, d):
        _add_files(half, files)
        start(_files_stream(spark, files), lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save(), ckpt,
              available_now=True, counts_path=counts).awaitTermination()
    return batch_counts(spark, counts).agg(F.count(F.lit(1)).alias("n_batches"), F.sum("n").alias("n_messages"))


# ---------------------------------------------------------------- ALS (rows in SQL, the model by facts that must hold)

def q_als_recommend(spark, d):
    """M3 settings + S11/K11 + M6: fit on the train split, save, load, top-k for every known user."""
    from ratewise.operators import als
    from ratewise.sources.models import load_model, save_model
    train, _ = _split(spark, d)
    model = als.fit_als(train, **als.DATAFRAME_CALL)
    path = save_model(model, scratch_path(spark, "als-model"))
    loaded = load_model(path)
    recs = als.recommend_users(loaded, popular.distinct_users(train), K)
    rows = recs.select("user_id", F.posexplode("recommendations").alias("pos", "r")).select(
        "user_id", "pos", "r.movie_id", "r.rating")
    # the saved model's factors give each score again, and each item was trained on
    trained = train.select("movie_id").distinct().withColumn("trained", F.lit(True))
    rows = score_pairs(rows, model.userFactors, model.itemFactors).join(trained, "movie_id", "left")
    score = F.round("rating", 9)
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_recs"),
        F.bool_and(F.coalesce("trained", F.lit(False))).alias("items_trained"),
        F.bool_and(F.abs(F.col("prediction") - F.col("rating")) < 1e-6).alias("scores_agree"),
        (F.transform(F.array_sort(F.collect_list(F.struct("pos", score.alias("s")))), lambda x: x["s"])
         == F.sort_array(F.collect_list(score), asc=False)).alias("best_first"))


def q_als_grid(spark, d):
    """M4 + M5 + A9: the reference's grid (rank 1), evaluated on the held-out split.  ``same_rmse``: a
    candidate's model and its factor tables agree.  ``not_below_winner``: scored by joins with factor
    tables, no candidate beats the model that the search returned, saved and loaded again."""
    from ratewise.operators import als
    from ratewise.sources.models import load_model, save_model
    train, test = _split(spark, d)
    metrics, _, winner = als.grid_search(train, test)
    saved = load_model(save_model(winner, scratch_path(spark, "als-winner")))
    scored = score_pairs(test.select("user_id", "movie_id"), saved.userFactors, saved.itemFactors)
    least = regression_metrics(match_truth(scored, test)).select("rmse").scalar()
    return metrics.select("candidate", "reg", "max_iter", "n_matched", (F.abs(F.col("rmse") - F.col("rmse_tables")) < 1e-4).alias("same_rmse"),
                          (F.col("rmse_tables") >= least - 1e-6).alias("not_below_winner"))


def _hash_train_test(ratings, keys):
    """The repeatable 0.8/0.2 split of ratings that are derived once."""
    return split.hash_split(cut_lineage(ratings), keys, HASH_TRAIN_WEIGHT)


def q_als_evaluate(spark, d):
    """O5 + M3 + J5 + A8: repeatable 0.8/0.2 split, ALS fit, evaluated on the held-out pairs."""
    from ratewise.operators import als
    train, test = _hash_train_test(V.ratings(spark, d), ("user_id", "movie_id"))
    return als.checked_evaluation(als.fit_als(train, **als.DATAFRAME_CALL), train, test)


def q_als_static_eval(spark, d):
    """M1 + M5: the static call's settings (rank 1, 20 iterations, lambda 0.001)."""
    from ratewise.operators import als
    train, test = _hash_train_test(V.ratings(spark, d), ("user_id", "movie_id"))
    return als.checked_evaluation(als.fit_als(train, **als.STATIC_CALL), train, test)


def q_als_train_eval(spark, d):
    """M2 + M5 + A6/A7: the builder settings (rank 10, 30 iterations, lambda 0.006, lineage cut
    every 5), evaluated on the held-out sorted split."""
    from ratewise.operators import als
    train, test = _split(spark, d)
    return als.checked_evaluation(als.fit_als(train, **als.BUILDER_CALL), train, test)


def q_als_dcolon_eval(spark, d):
    """P5 + O5 + M3 + A8: ``user::movie::rating::ts`` lines parsed strictly, repeatable 0.8/0.2
    split, ALS on ``userId``/``movieId``/``rating``, evaluated on the held-out rows."""
    from ratewise.operators import als
    keys = ("userId", "movieId")
    train, test = _hash_train_test(parse.parse_dcolon(V.dcolon_lines(spark, d)), keys)
    model = als.fit_als(train, **als.DATAFRAME_CALL, user_col=keys[0], item_col=keys[1])
    return als.checked_evaluation(model, train, test, keys)


QUERIES: dict[str, Query] = {
    "popular_items": q_popular_items,
    "row_counts": q_row_counts,
    "distinct_users": q_distinct_users,
    "filter_rows": q_filter_rows,
    "split_train": q_split_train,
    "split_test": q_split_test,
    "split_hash": q_split_hash,
    "anti_blacklist": q_anti_blacklist,
    "classify_users": q_classify_users,
    "score_pairs": q_score_pairs,
    "rmse_fixed": q_rmse_fixed,
    "rmse_matched": q_rmse_matched,
    "metrics_all": q_metrics_all,
    "best_params": q_best_params,
    "parse_links": q_parse_links,
    "parse_movies": q_parse_movies,
    "parse_tags": q_parse_tags,
    "parse_ratings": q_parse_ratings,
    "parse_dcolon": q_parse_dcolon,
    "parse_rejects": q_parse_rejects,
    "text_scan": q_text_scan,
    "encode_message": q_encode_message,
    "decode_users": q_decode_users,
    "topk_factors": q_topk_factors,
    "topk_pruned": q_topk_pruned,
    "encode_ids": q_encode_ids,
    "encode_scored": q_encode_scored,
    "recommend_cold_start": q_recommend_cold_start,
    "upsert_actions": q_upsert_actions,
    "upsert_result": q_upsert_result,
    "table_roundtrip": q_table_roundtrip,
    "stream_distinct_users": q_stream_distinct_users,
    "stream_recommend": q_stream_recommend,
    "stream_replay": q_stream_replay,
    "stream_restart": q_stream_restart,
    "stream_failed_batch": q_stream_failed_batch,
    "stream_model_only": q_stream_model_only,
    "stream_counts": q_stream_counts,
    "stream_offsets": q_stream_offsets,
    "als_recommend": q_als_recommend,
    "als_grid": q_als_grid,
    "als_evaluate": q_als_evaluate,
    "als_static_eval": q_als_static_eval,
    "als_train_eval": q_als_train_eval,
    "als_dcolon_eval": q_als_dcolon_eval,
}
