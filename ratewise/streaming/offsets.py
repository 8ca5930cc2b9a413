"""Source offsets of every batch as a table.

The reference reads a batch's offset ranges inside the batch and stores where it began.  In
Structured Streaming they come with the query's progress, which a listener hands over after each
finished batch: ``OffsetLog`` writes one row per run, batch and source, keyed by (run, batch id), so
that a batch reported twice (once before and once after a restart) is one row.  ``resume`` turns the
newest row into a reader's start options.

Progress of batches without data is not kept.  A batch that was finished but not yet reported when
the driver died is missing from the table; the query's own checkpoint still has it, and the next
batch's start shows the gap (``gaps``).
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ratewise.sources.tables import path_exists

SCHEMA = "source int, start_offset string, end_offset string, n_rows bigint, run string, batch_id bigint"


class OffsetLog(StreamingQueryListener):
    """Context manager: follows queries and writes their offsets under ``path``."""

    def __init__(self, spark: SparkSession, path: str, run: str = "run"):
        super().__init__()
        self.spark, self.path, self.run = spark, path.rstrip("/"), run
        self._mine: set[str] = set()
        self._early: list = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def __enter__(self) -> "OffsetLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def follow(self, query: StreamingQuery, wait: bool = True) -> StreamingQuery:
        """Keep this query's offsets; with ``wait`` until it has ended and all are written."""
        run_id = str(query.runId)
        with self._changed:
            self._mine.add(run_id)
            for p in self._early:
                if str(p.runId) == run_id:
                    self._write(p)
            self._early = []
        if wait:
            query.awaitTermination()
            with self._changed:     # events come in order, the last one after all progress
                self._changed.wait_for(lambda: run_id in self._ended, timeout=60)
        return query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._changed:
            if str(p.runId) in self._mine:
                self._write(p)
            elif not self._mine:
                self._early.append(p)       # reported before ``follow`` was called

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _write(self, progress) -> None:
        json_or_none = lambda o: None if o in (None, "None", "null") else o  # noqa: E731  (a first batch has no start)
        rows = [(k, json_or_none(s.startOffset), json_or_none(s.endOffset), int(s.numInputRows), self.run, int(progress.batchId))
                for k, s in enumerate(progress.sources) if s.startOffset != s.endOffset]
        if rows:
            (self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(self.path))

    def table(self) -> DataFrame:
        """``run, batch_id, source, start_offset, end_offset`` (JSON, as the source gives them), ``n_rows``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path).select(
            "run", "batch_id", "source", "start_offset", "end_offset", "n_rows")


def gaps(offsets: DataFrame) -> DataFrame:
    """Batches that do not start where the one before them in the table ended."""
    by = Window.partitionBy("run", "source").orderBy("batch_id")
    return (offsets.withColumn("_last", F.lag("end_offset").over(by))
            .filter(F.col("_last").isNotNull() & ~F.col("_last").eqNullSafe(F.col("start_offset"))).drop("_last"))


def resume(offsets: DataFrame, run: str, replay_last: bool = False, source: int = 0) -> dict:
    """Reader options that go on after a run's last batch (``startingOffsets``, as Kafka takes them);
    ``replay_last`` starts at its beginning, as the reference's stored offsets do."""
    last = offsets.filter((F.col("run") == run) & (F.col("source") == source)).agg(
        F.max_by(F.struct("start_offset", "end_offset"), "batch_id").alias("x")).first()["x"]
    at = last and (last["start_offset"] if replay_last else last["end_offset"])
    return {"startingOffsets": json.dumps(json.loads(at))} if at else {"startingOffsets": "earliest"}
