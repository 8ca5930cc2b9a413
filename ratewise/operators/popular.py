"""Counts and popularity.

``top_items`` is a partial/final hash aggregate (map-side combine, so one item holding a third
of all rows collapses to one row per task before the shuffle) followed by Spark's
``TakeOrderedAndProject``: each task keeps its best ``k`` and only those reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_items(ratings: DataFrame, k: int = 5, item_col: str = "movie_id") -> DataFrame:
    """A3: the ``k`` most-rated items, ties broken by item id (the reference leaves ties open)."""
    return (ratings.groupBy(item_col).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc(item_col)).limit(k))


def top_items_row(ratings: DataFrame, k: int = 5, item_col: str = "movie_id") -> DataFrame:
    """One row ``popular: array<int>`` (ids in rank order) -- the broadcast side value of J7."""
    top = top_items(ratings, k, item_col)
    ranked = top.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("cnt")).alias("neg_cnt"), F.col(item_col).alias("id")))).alias("s"))
    return ranked.select(F.transform("s", lambda x: x["id"]).alias("popular"))


def row_counts(df: DataFrame, fractions=(0.6,)) -> DataFrame:
    """A1 + F7: ``n`` and ``floor(n * f)`` / ``floor(n * (1 - f))`` split sizes (double maths)."""
    n = F.count(F.lit(1))
    cols = [n.alias("n_rows")]
    for f in fractions:
        tag = str(f).replace(".", "")
        cols.append(F.floor(n * F.lit(float(f))).cast("bigint").alias(f"n_train_{tag}"))
        cols.append(F.floor(n * F.lit(1 - float(f))).cast("bigint").alias(f"n_test_{tag}"))
    return df.agg(*cols)


def distinct_users(df: DataFrame, user_col: str = "user_id") -> DataFrame:
    """A2: ``select user_id ... group by user_id``."""
    return df.select(user_col).distinct()


def filter_counts(ratings: DataFrame, threshold: float, user_id: int) -> DataFrame:
    """P14 + P15: rows above a rating threshold and rows of one user.

    Two filters, not one conditional pass: the user's predicate then reaches the scans below."""
    n = F.count(F.lit(1))
    of_user = ratings.filter(F.col("user_id") == F.lit(user_id)).agg(n.alias("n")).scalar()
    return (ratings.filter(F.col("rating") > F.lit(threshold)).agg(n.alias("n_above"))
            .withColumn("n_user", of_user))
