"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch: with texts of a few KB a batch stays at a few MB in a Python worker.
ARROW_ROWS = 512

#: The ASCII letters that the operators' contracts fold.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the texts a Python worker holds at once (read when a plan with Python is executed)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int = ARROW_ROWS):
    """``small_batches`` for the plans executed within it; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def finished_shuffles_deleted(spark: SparkSession):
    """Within it, a plan's shuffle files go as soon as its result is written (Spark else keeps them
    until the driver happens to collect its garbage).  For steps that end in written tables."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, alias: str = "_row") -> Column:
    """All columns as one struct, so that an operator's own columns cannot clash with them."""
    return F.struct(*[quoted(c) for c in df.columns]).alias(alias)


def unpacked(df: DataFrame, columns: list[str], alias: str = "_row") -> DataFrame:
    return df.select(*[F.col(alias).getField(c).alias(c) for c in columns])


def ascii_lower(c: Column) -> Column:
    """A-Z folded, every other code point kept; pure-ASCII text takes the fast ``lower``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def sha256_text(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")).cast("binary"), 256)
