"""The four jobs of the reference, composed from the operators (one call each).

1. ``etl``              text files -> typed tables (S1, P1-P4, K1-K2)
2. ``split_and_train``  ratings table -> train/test tables, ALS fit (or grid), evaluation, saved
                        model with the score in its path, metrics table (O4, M1-M5, A6-A9, K11)
3. ``batch_recommend``  known users -> top-k -> scored text -> sink (A2, M6, P12, K4-K5)
4. ``stream_recommend`` messages -> per-batch recommendation -> daily-guarded upsert (T1-T10)

Each job reads and writes through tables or the caller's sink; nothing is gathered on the driver.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.codec import day_text
from ratewise.operators import als, parse, popular, split
from ratewise.operators.recommend import encoded, recommend
from ratewise.operators.upsert import UserTable
from ratewise.sources.jdbc import jdbc_append, jdbc_upsert
from ratewise.sources.models import model_path, save_model
from ratewise.sources.tables import cut_lineage, read_table, save_table
from ratewise.sources.text import read_lines
from ratewise.streaming.job import RecommendBatch, run_until_marker, start, stop_on_signal

MIN_PARTITIONS = 8   # the reference's minimum split count for its text inputs


def etl(spark: SparkSession, paths: dict[str, str], database: str | None = None, mode: str = "overwrite",
        fmt: str = "parquet", parse_mode: str = parse.STRICT, min_partitions: int = MIN_PARTITIONS) -> dict:
    """Job 1: ``paths`` maps ``links|movies|tags|ratings`` to text files; returns table names.

    With ``parse_mode="permissive"`` the rejected lines go to ``<name>_rejects``."""
    out = {}
    for name, path in paths.items():
        parsed = parse.PARSERS[name](read_lines(spark, path, min_partitions), parse_mode)
        table = f"{database}.{name}" if database else name
        if parse_mode == parse.PERMISSIVE:
            parsed, rejects = parsed
            save_table(rejects, f"{table}_rejects", mode, fmt, replace=True)
        save_table(parsed, table, mode, fmt, replace=True)
        out[name] = table
    return out


def split_and_train(spark: SparkSession, ratings_table: str, model_base: str, train_table: str = "trainingdata",
                    test_table: str = "testdata", metrics_table: str | None = "model_metrics",
                    fraction: float = 0.6, grid: bool = False, settings: dict | None = None) -> dict:
    """Job 2: split, store both sides, fit (one model with ``settings`` or the grid), evaluate on
    the held-out side, save the best model under ``i_<iter>_l0_<lambda>_<rmse>``."""
    ratings = read_table(spark, ratings_table, ["user_id", "movie_id", "rating"])
    train, test = split.sorted_fraction_split(ratings, fraction)
    save_table(train, train_table, replace=True)
    save_table(test, test_table, replace=True)
    train, test = read_table(spark, train_table), read_table(spark, test_table)
    n_test = ratings.agg(F.floor(F.count(F.lit(1)) * F.lit(1 - fraction)).alias("n")).scalar()
    if grid:
        metrics, best, model = als.grid_search(train, test, denominator=n_test)
        row = best.first()
        reg, iters, rmse = row["reg"], row["max_iter"], row["rmse"]
    else:
        cfg = {**als.BUILDER_CALL, **(settings or {})}
        model = als.fit_als(train, **cfg)
        metrics = cut_lineage(als.evaluate(model, test, test, n_test).select(
            F.lit(0).alias("candidate"), F.lit(float(cfg["reg"])).alias("reg"),
            F.lit(int(cfg["max_iter"])).alias("max_iter"), F.lit(int(cfg["rank"])).alias("rank"), "*"))
        row = metrics.first()
        reg, iters, rmse = cfg["reg"], cfg["max_iter"], row["rmse"]
    path = save_model(model, model_path(model_base, iters, reg, rmse))
    if metrics_table:
        save_table(metrics.withColumn("model_path", F.lit(path)), metrics_table, mode="append")
    return {"model_path": path, "rmse": rmse, "train": train_table, "test": test_table}


def batch_recommend(spark: SparkSession, model, users: DataFrame, sink: Callable[[DataFrame], None],
                    k: int = 5, cold_start: str = "drop", popular_items: DataFrame | None = None,
                    scale: int | None = None) -> DataFrame:
    """Job 3: ``(user_id, res)`` with ``movie_id=..,rating=..`` text for every requested user,
    handed to ``sink`` (e.g. ``jdbc_sink``).  ``model`` is an ``ALSModel`` or a
    ``(user_factors, item_factors)`` pair."""
    uf, vf = (model.userFactors, model.itemFactors) if hasattr(model, "userFactors") else model
    recs = recommend(users.select("user_id").distinct(), uf, vf, k, cold_start, popular_items)
    out = encoded(recs, "scored", scale)
    sink(out)
    return out


def jdbc_sink(url: str, table: str, props: dict | None = None, batchsize: int = 1000,
              day: str | None = None) -> Callable[[DataFrame], None]:
    """K4-K6: blind append of ``(user_id, res[, day])`` rows (the reference's batch job)."""
    def write(df: DataFrame) -> None:
        rows = df if day is None else df.withColumn("day", F.lit(day))
        jdbc_append(rows, url, table, props, batchsize)
    return write


def jdbc_upsert_sink(spark: SparkSession, url: str, table: str, staging: str, props: dict | None = None,
                     day: str | None = None) -> Callable[[DataFrame, int], None]:
    """K8 against a database table, for ``stream_recommend(sink=...)``: each batch is staged in a table
    of its own and classified in the database, by key lookups; nothing of the target is read out."""
    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc_upsert(spark, batch.select("user_id", "res", day_text(day).alias("day")), url, table, staging, props, batch_id=batch_id)
    return write


def stream_recommend(spark: SparkSession, messages: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                     ratings: DataFrame, checkpoint_location: str, store_path: str | None = None,
                     sink: Callable[[DataFrame, int], None] | None = None, k: int = 5,
                     cold_start: str = "popular", marker: str | None = None, poll_seconds: float = 60.0,
                     processing_time: str = "3 seconds", available_now: bool = False,
                     counts_path: str | None = None):
    """Job 4: start the recommendation stream; with ``marker`` block until the marker file appears.

    The popular list is computed once and checkpointed (T10); ``store_path`` keeps the target as
    a ``UserTable``, ``sink`` is any other per-batch writer (``jdbc_upsert_sink``), ``counts_path`` a table of rows per batch."""
    pop = popular.top_items_row(ratings, k).checkpoint(eager=True) if cold_start == "popular" else None
    store = UserTable(spark, store_path) if store_path else None
    fn = RecommendBatch(user_factors, item_factors, pop, store, k, cold_start, sink=sink, run=checkpoint_location)
    q = start(messages, fn, checkpoint_location, processing_time=processing_time, available_now=available_now,
              counts_path=counts_path)
    if threading.current_thread() is threading.main_thread():
        stop_on_signal(q)
    if marker:
        run_until_marker(spark, q, marker, poll_seconds)
    return q
