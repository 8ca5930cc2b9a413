"""Text scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def min_splits(scan: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """A file scan with at least ``min_partitions`` partitions (default: the cluster's parallelism).

    Splits normally come from ``spark.sql.files.maxPartitionBytes``; a round-robin repartition is
    added only when the scan has fewer (one small file, one row group).  On a large input it is a
    no-op.  Asking a plain scan for its partition count lists files; it runs no job.
    """
    n = min_partitions or scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() < n:
        return scan.repartition(n)
    return scan


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One ``value`` row per line, at least ``min_partitions`` partitions."""
    df = spark.read.text(path)
    return min_splits(df, min_partitions) if min_partitions else df


def read_text_dataset(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.textFile`` equivalent (the same ``value`` column)."""
    return spark.read.text(path).select("value")
