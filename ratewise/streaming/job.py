"""Streaming recommendation job (S8-S10, T1-T11, A4, A11, K12) on Structured Streaming.

Per micro-batch (``foreachBatch``) one DataFrame plan does what the reference did with a
collect and a driver loop of one Spark job per user:

    decode user ids (P10) -> distinct (A4) -> known? (J3, one join) ->
    model top-k (J6) | popular ids (J7) -> ids text (P13) -> daily-guarded upsert (K8)

Delivery: the source offsets and the commit log live in ``checkpointLocation`` (T6/T7).  A batch
replayed after a failure carries the same ``batch_id`` and writes the same rows again.  ``offsets``
keeps the source offsets of every finished batch as a table (T3).
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratewise.functions.codec import decode_user
from ratewise.operators.recommend import encoded, recommend
from ratewise.operators.upsert import UserTable
from ratewise.sources.tables import cut_lineage, path_exists

BATCH_SECONDS = 3     # T1


def file_stream(spark: SparkSession, directory: str, file_glob: str, schema, max_files_per_trigger: int = 1,
                fmt: str = "parquet") -> DataFrame:
    """File source (tests and replays): the directory plus a glob naming the files to read."""
    return (spark.readStream.format(fmt).schema(schema)
            .option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(directory))


def batch_users(messages: DataFrame, strict: bool = True) -> DataFrame:
    """P10 + A4/A5: distinct user ids of a batch of ``value`` messages."""
    return messages.select(decode_user("value", strict).alias("user_id")).distinct()


class RecommendBatch:
    """The ``foreachBatch`` function of the recommendation stream (T4, T5).

    Loaded once per application (T10): the factor tables and the popular ids are fixed when the
    object is built and reused by every batch.

    ``store``      a ``UserTable`` (K8 sink); ``None`` for the V2 mode without a write (T5)
    ``sink``       optional callable ``(encoded_batch_df, batch_id)`` for other outputs
    ``run``        name of the run, as its checkpoint folder: keys its batch outputs; a table that
                   the run left half replaced is mended when the object is built
    """

    def __init__(self, user_factors: DataFrame, item_factors: DataFrame, popular: DataFrame | None,
                 store: UserTable | None = None, k: int = 5, cold_start: str = "popular",
                 day: str | None = None, strict: bool = True,
                 sink: Callable[[DataFrame, int], None] | None = None, run: str = "run"):
        # loaded once per application and kept (memory, spilling to disk) for every batch
        self.user_factors = user_factors.persist(StorageLevel.MEMORY_AND_DISK)
        self.item_factors = item_factors.persist(StorageLevel.MEMORY_AND_DISK)
        self.popular = popular
        self.store = store
        self.k = k
        self.cold_start = cold_start
        self.day = day
        self.strict = strict
        self.sink = sink
        self.run = run
        self.n_items = item_factors.count()   # fixed for the application (T10)
        if store is not None:
            store.recover(run)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # the batch's distinct users, written once; the same pass tells their count, which bounds
        # the broadcasts, and their buckets, which bound what is read and written of the table
        seen = Observation()
        facts = [F.count(F.lit(1)).alias("n")] + ([F.collect_set(self.store.bucket()).alias("buckets")] if self.store else [])
        users = cut_lineage(batch_users(batch, self.strict).observe(seen, *facts))
        n_users = seen.get["n"]
        recs = recommend(users, self.user_factors, self.item_factors, self.k, self.cold_start, self.popular,
                         n_items=self.n_items, n_users=n_users)
        out = encoded(recs, "ids")
        if self.store is not None and n_users:
            self.store.write_batch(batch_id, out, self.day, self.run, sorted(seen.get["buckets"]))
        if self.sink is not None:
            self.sink(out, batch_id)


def start(messages: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint_location: str,
          processing_time: str | None = f"{BATCH_SECONDS} seconds", available_now: bool = False,
          query_name: str | None = None, counts_path: str | None = None) -> StreamingQuery:
    """``foreachBatch`` query with a checkpoint; ``available_now`` drains and stops.

    With ``counts_path`` the rows of every batch are counted into that table (A11) by the pass in
    which ``fn`` reads them, so ``fn`` has to read its batch; see ``batch_counts``."""
    if counts_path:
        fn = _counted(fn, counts_path)
    w = messages.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def console(messages: DataFrame, checkpoint_location: str, processing_time: str = f"{BATCH_SECONDS} seconds",
            num_rows: int = 20, available_now: bool = False) -> StreamingQuery:
    """Print each batch (debugging)."""
    w = (messages.writeStream.format("console").option("numRows", num_rows).option("truncate", "false")
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def stop_between_batches(query: StreamingQuery, max_wait: float = 600.0) -> None:
    """Let the running batch end, then stop.  On a stream that is behind the next batch begins at once;
    it is interrupted at its beginning and its checkpoint replays it.  After ``max_wait`` seconds the
    query is stopped within a batch, which is replayed as well."""
    def last() -> int:
        progress = query.lastProgress
        return -1 if progress is None else progress["batchId"]

    before, until = last(), time.monotonic() + max_wait
    while query.isActive and query.status.get("isTriggerActive") and last() <= before and time.monotonic() < until:
        time.sleep(0.02)
    query.stop()


def stop_on_signal(query: StreamingQuery, signals=(signal.SIGTERM, signal.SIGINT), max_wait: float = 600.0) -> threading.Event:
    """T9, at shutdown: a signal lets the running batch end, then the query stops and whoever awaits it
    goes on.  The handler only sets the event returned; a thread does the waiting, as a handler may
    interrupt the main thread within a call to Spark.  To be called from the main thread."""
    asked = threading.Event()

    def wait() -> None:
        while query.isActive:
            if asked.wait(0.2):
                stop_between_batches(query, max_wait)
                return

    threading.Thread(target=wait, name="stop-on-signal", daemon=True).start()
    for s in signals:
        signal.signal(s, lambda *_: asked.set())
    return asked


def run_until_marker(spark: SparkSession, query: StreamingQuery, marker: str, poll_seconds: float = 60.0,
                     max_polls: int | None = None, max_wait: float = 600.0) -> bool:
    """Poll every ``poll_seconds``; stop the query between batches once ``marker`` exists.

    Returns True when stopped by the marker, False when the query ended by itself (or
    ``max_polls`` ran out).
    """
    polls = 0
    while True:
        if query.awaitTermination(poll_seconds):
            return False
        if path_exists(spark, marker):
            stop_between_batches(query, max_wait)
            return True
        polls += 1
        if max_polls is not None and polls >= max_polls:
            return False


def _counted(fn: Callable[[DataFrame, int], None], path: str) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, batch_id: int) -> None:
        # counted by the pass in which ``fn`` reads the batch; keyed by batch id: a replayed batch
        # writes its own count again
        seen = Observation()
        fn(batch.observe(seen, F.count(F.lit(1)).alias("n")), batch_id)
        (batch.sparkSession.createDataFrame([(seen.get["n"], batch_id)], "n bigint, batch_id bigint").coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    return run


def batch_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """``(batch_id, n)``, the input rows of every batch so far, over all restarts."""
    return spark.read.schema("n bigint, batch_id bigint").parquet(counts_path).select("batch_id", "n")


def distinct_users_per_batch(messages: DataFrame, out_path: str, checkpoint_location: str,
                             available_now: bool = True) -> StreamingQuery:
    """Stream of ``(batch_id, user_id)``: the de-duplicated users of each batch, appended as parquet."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch_users(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))
    return start(messages, write, checkpoint_location, available_now=available_now)
