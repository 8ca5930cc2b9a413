"""Session helpers.

The library never creates its own scratch folders on a cluster: lineage cuts and stream state go
to the shared folder named by ``spark.checkpoint.dir``.  Only a local-mode session without that
setting (tests, a laptop) gets a private folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every ratewise job wants: adaptive execution (runtime join choice, partition
# coalescing, skew splitting) and UTC so that day strings do not depend on the host zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # per-batch checkpoints (stream) are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app_name: str = "ratewise",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, read from the session.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir``.  When neither is set a
    local-mode session gets a fresh temp folder; a cluster session raises, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="ratewise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream checkpoints, upsert stores)."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


def ensure_local_dir(path: str) -> str:
    """Create ``path`` when it is a plain local path (file: URIs and remote schemes are left alone)."""
    if "://" not in path and not path.startswith("file:"):
        os.makedirs(path, exist_ok=True)
    return path
