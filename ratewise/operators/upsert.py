"""Daily-guarded upsert of recommendations.

Rule (the reference's ``insertAndUpdate``): for each incoming ``(user_id, res)``
  * user absent from the target          -> insert ``(user_id, res, today)``
  * user present, stored day != today     -> update every row of that user to ``(res, today)``
  * user present, stored day == today     -> skip (the first write of the day wins)
When the target holds several rows of one user, its latest day decides.

Everything is joins on ``user_id``: the incoming batch is joined with the target's keys
(a left join, J4), and the new target is ``target anti updated users  UNION  inserts+updates``
(a keyed overwrite, K7).  ``UserTable`` keeps the target as a plain parquet table partitioned by a
hash bucket of the user id; a batch joins the buckets it touches and overwrites just these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.codec import day_text
from ratewise.sources.tables import cut_lineage, path_exists

INSERT, UPDATE, SKIP = "insert", "update", "skip"
BUCKETS = 64                    # hash buckets of a new table; a batch rewrites only those it touches


def target_days(target: DataFrame, user_col: str = "user_id") -> DataFrame:
    """One ``(user_id, day)`` per stored user (latest day if a user repeats)."""
    return target.groupBy(user_col).agg(F.max("day").alias("_stored_day")).withColumn("_stored", F.lit(True))


def classify(incoming: DataFrame, target: DataFrame, day=None, user_col: str = "user_id") -> DataFrame:
    """``incoming`` + ``action`` + ``day`` (the run day, a parameter; default today)."""
    today = day_text(day)
    stored = target_days(target, user_col)
    j = incoming.join(stored, user_col, "left")
    # a stored user may have no day: presence is a flag of its own
    action = (F.when(F.col("_stored").isNull(), F.lit(INSERT))
              .when(~F.col("_stored_day").eqNullSafe(today), F.lit(UPDATE))
              .otherwise(F.lit(SKIP)))
    return j.select(*incoming.columns, action.alias("action"), today.alias("day"))


def apply_actions(target: DataFrame, actions: DataFrame, user_col: str = "user_id",
                  materialize: bool = True) -> DataFrame:
    """K6+K7: the target after inserting and updating (skipped rows leave it unchanged).

    The written rows feed both the anti join and the union; ``materialize`` checkpoints them
    once (shared folder) so the plan that produced them is not run twice.
    """
    written = actions.filter(F.col("action") != SKIP).select(user_col, "res", "day")
    if materialize:
        written = cut_lineage(written)
    kept = target.join(written.select(user_col), user_col, "left_anti")
    return kept.select(user_col, "res", "day").unionByName(written)


def upsert(target: DataFrame, incoming: DataFrame, day=None, user_col: str = "user_id") -> DataFrame:
    return apply_actions(target, classify(incoming, target, day, user_col), user_col)


class UserTable:
    """A ``rec_user`` table, one row per user: parquet under ``path/table``, partitioned by bucket.

    ``write_batch`` is an idempotent read-modify-write.  It joins the stored rows of the touched
    buckets with the batch, writes their new contents to ``path/batches`` keyed by run and batch id,
    and from there overwrites these buckets of the table (dynamic partition overwrite).  A batch
    replayed by the stream's checkpoint finds its users served today and writes the same rows again,
    so the checkpoint is the only log.

    Spark replaces partitions one after another when a write commits.  If the driver dies between
    removing a bucket and putting the new one in its place, the bucket is missing from the table but
    stands in the last batch: ``recover(run)``, called when a run starts, puts it back.  A run that
    died is to be started again (or recovered) before another run writes; one run writes at a time.
    Only the last batch of a run is ever read again: older partitions of ``batches`` may be dropped.

    The bucket count is a partition column, so an existing table keeps its own.  Each batch rewrites
    its buckets whole: give a large table as many buckets as keeps one at a few megabytes.
    """

    def __init__(self, spark: SparkSession, path: str, user_col: str = "user_id", buckets: int = BUCKETS):
        self.spark, self.path, self.user_col = spark, path.rstrip("/"), user_col
        self.table, self.batches = f"{self.path}/table", f"{self.path}/batches"
        stored = self._stored().select("n_buckets").first()
        self.buckets = stored[0] if stored else buckets

    def bucket(self) -> Column:
        return F.pmod(F.hash(F.col(self.user_col).cast("bigint")), F.lit(self.buckets))

    def _stored(self) -> DataFrame:
        schema = f"{self.user_col} int, res string, day string, n_buckets int, bucket int"
        if not path_exists(self.spark, self.table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.table)

    def _write(self, rows: DataFrame, mode: str = "overwrite") -> None:
        rows = rows.select(self.user_col, "res", "day", F.lit(self.buckets).alias("n_buckets"), "bucket")
        # few files a bucket; adaptive execution splits large buckets and joins small ones
        (rows.hint("rebalance", "bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy("n_buckets", "bucket").parquet(self.table))

    def init(self, base: DataFrame) -> "UserTable":
        """Replace the table by ``base``, one row per user (the latest day, then res)."""
        latest = base.groupBy(self.user_col).agg(F.max(F.struct("day", "res")).alias("_s"))
        self._write(latest.select(self.user_col, "_s.res", "_s.day", self.bucket().alias("bucket")))
        return self

    def state(self) -> DataFrame:
        return self._stored().select(self.user_col, "res", "day")

    def stored(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of these buckets; a partition filter."""
        rows = self._stored()
        if buckets is not None and len(buckets) < self.buckets:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return rows.select(self.user_col, "res", "day", "bucket")

    def write_batch(self, batch_id: int, incoming: DataFrame, day=None, run: str = "run",
                    buckets: list[int] | None = None) -> None:
        """K8 for one batch of ``(user, res)``, one row per user; ``buckets``: those its users fall into
        (read if not given)."""
        today = day_text(day)
        if buckets is None:
            buckets = [r[0] for r in incoming.select(self.bucket()).distinct().collect()]      # at most the bucket count
        old = self.stored(buckets).select(self.user_col, F.col("res").alias("_res"), F.col("day").alias("_day"), F.lit(True).alias("_known"))
        new = incoming.select(self.user_col, "res")
        # one row per user on both sides: stored and served today stays, everything else that arrives is written
        joined = old.join(new.withColumn("_new", F.lit(True)), self.user_col, "full_outer")
        keep = F.col("_new").isNull() | (F.col("_known").isNotNull() & F.col("_day").eqNullSafe(today))
        rows = joined.select(self.user_col, F.when(keep, F.col("_res")).otherwise(F.col("res")).alias("res"),
                             F.when(keep, F.col("_day")).otherwise(today).alias("day"), self.bucket().alias("bucket"))
        at = self._batch_path(run, batch_id)
        rows.write.mode("overwrite").parquet(at)
        self._write(self.spark.read.schema(rows.schema).parquet(at))

    def _batch_path(self, run: str, batch_id: int | None = None) -> str:
        at = f"{self.batches}/run={_name(run)}"
        return at if batch_id is None else f"{at}/batch_id={batch_id}"

    def recover(self, run: str) -> int:
        """Put back the buckets of the run's last batch that an interrupted commit removed; their number."""
        at = self._batch_path(run)
        if not path_exists(self.spark, at):
            return 0
        written = self.spark.read.schema(f"{self.user_col} int, res string, day string, bucket int, batch_id bigint").parquet(at)
        last = written.agg(F.max("batch_id")).first()[0]
        lost = (written.filter(F.col("batch_id") == F.lit(last)).join(self._stored().select("bucket").distinct(), "bucket", "left_anti"))
        lost = cut_lineage(lost)
        n = lost.select("bucket").distinct().count()
        if n:
            self._write(lost, "append")
        return n


def _name(run: str) -> str:
    """A run's name (its checkpoint folder) as a folder name."""
    return "".join(c if c.isalnum() or c in "-." else "_" for c in run)[-120:]
