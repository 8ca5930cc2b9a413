"""Catalog tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ratewise.session import checkpoint_dir, scratch_path


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str | None = "parquet",
               replace: bool = False, path: str | None = None, bucket_by: tuple[int, str] | None = None) -> None:
    """K1 (mode + format), K2 (``replace``: drop first), K3 (``fmt=None``: session default).

    ``path`` makes it an external table at that location (otherwise managed, in the warehouse).
    ``bucket_by=(n, column)`` stores the table hash-bucketed and sorted on ``column``, so later
    joins and aggregates on that key read it without a shuffle.
    Each task writes its own file, so the file count equals the partition count of ``df``."""
    spark = df.sparkSession
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    w = df.write.mode(mode)
    if fmt:
        w = w.format(fmt)
    if path:
        w = w.option("path", path)
    if bucket_by:
        n, column = bucket_by
        w = w.bucketBy(n, column).sortBy(column)
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """S3: catalog scan with an explicit column list (pruned at the file reader).

    A name containing ``/`` is read as a parquet table folder (no metastore needed)."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return df.select(*columns) if columns else df


def persist(df: DataFrame, memory_only: bool = False) -> DataFrame:
    """Keep a frame that several jobs reuse (memory + disk unless asked otherwise)."""
    return df.persist(StorageLevel.MEMORY_ONLY if memory_only else StorageLevel.MEMORY_AND_DISK)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """O8 for rows that several passes read: a parquet table in the shared checkpoint folder.  A pass
    reads the columns it needs, packed, and its filter reaches the reader; a checkpoint's rows come whole."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test on any Hadoop file system (HDFS, S3, local)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def export_rows(df: DataFrame):
    """Stream a finished result to the driver one partition at a time (export only; no
    operator in this library iterates rows on the driver)."""
    return df.toLocalIterator(prefetchPartitions=False)
