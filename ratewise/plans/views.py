"""Inputs of the reference's jobs, derived by Spark from the benchmark tables.

Every view reads whole tables; nothing is sampled or capped.  The same definitions are written
as SQL in ``plans/oracle.py`` (``VIEW_SQL``) for the DuckDB cross-check.

ratings        orders x lineitem: user = customer, item = part, rating = avg(quantity)/10
movies_lines   one text line per part, in seven shapes (quoted titles with commas, trailing
               commas, padding, empty title, too few fields)
tags_lines     one line per event, six shapes (quoted tags with commas, too few fields ...)
links_lines    one line per part, four shapes
ratings_lines  one line per lineitem row, four shapes
dcolon_lines   one ``user::movie::rating::ts`` line per lineitem row
bad_lines      ratings lines with broken numbers for the permissive parser
messages       one stream message per event: key, value = user_movie_rating
rec_user       recommendation target table: customers outside the MACHINERY segment (those are
               the users never served); day is the day before ``TODAY`` for the BUILDING and
               AUTOMOBILE segments and ``TODAY`` for the rest
factors        embeddings as a factor model: rows with vec_id % 5 = 0 are users, the rest items
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.sources.text import min_splits

# Fixed values of the fixtures.
TODAY = "2024-01-31"
YESTERDAY = "2024-01-30"
OLD_SEGMENTS = ("BUILDING", "AUTOMOBILE")
NEW_SEGMENTS = ("MACHINERY",)
FIXTURE_RES = "1_2_3_4_5"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """A pruned scan of a large table, spread over the cluster when its file has too few splits
    (the reference reads its text inputs with a minimum partition count)."""
    return min_splits(table(spark, sf_dir, name).select(*columns))


def s(c) -> Column:
    """Column as text (integers print the same in Spark and SQL engines)."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = fact(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .groupBy("o_custkey", "l_partkey")
            .agg((F.avg("l_quantity") / 10).alias("rating"))
            .select(F.col("o_custkey").cast("int").alias("user_id"),
                    F.col("l_partkey").cast("int").alias("movie_id"), "rating"))


def movies_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 7
    line = (F.when(k == 0, F.concat(s("p_partkey"), F.lit(',"'), F.col("p_name"), F.lit(", The ("),
                                    s("p_size"), F.lit(')",'), F.col("p_type")))
            .when(k == 1, F.concat(s("p_partkey"), F.lit(","), F.col("p_name"), F.lit(",")))
            .when(k == 2, F.concat(s("p_partkey"), F.lit(',"'), F.col("p_name"), F.lit(", "),
                                   F.col("p_brand"), F.lit(', X",'), F.col("p_type")))
            .when(k == 3, F.concat(F.lit(" "), s("p_partkey"), F.lit(" , "), F.col("p_name"), F.lit(" ,"),
                                   F.col("p_type"), F.lit(" ")))
            .when(k == 4, F.concat(s("p_partkey"), F.lit(",,"), F.col("p_type")))
            .when(k == 5, s("p_partkey"))
            .otherwise(F.concat(s("p_partkey"), F.lit(","), F.col("p_name"), F.lit(","), F.col("p_type"))))
    return p.select(line.alias("value"))


def tags_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fact(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    k = F.col("event_id") % 6
    head = F.concat(s("user_id"), F.lit(","), s(F.col("event_id") % 200), F.lit(","))
    line = (F.when(k == 0, F.concat(head, F.col("event_type"), F.lit(","), s("event_id")))
            .when(k == 1, F.concat(head, F.lit('"'), F.col("event_type"), F.lit(", "), F.col("props"),
                                   F.lit('",'), s("event_id")))
            .when(k == 2, F.concat(head, s("event_id")))
            .when(k == 3, F.concat(head, F.lit(" "), F.col("event_type"), F.lit(" ,x,"), s("event_id")))
            .when(k == 4, F.concat(head, F.lit(","), s("event_id")))
            .otherwise(F.concat(head, F.col("event_type"), F.lit(","))))
    return e.select(line.alias("value"))


def links_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    imdb = F.lpad(s(F.col("p_partkey") * 7), 7, "0")
    tmdb = s(F.col("p_partkey") * 3 + 1)
    line = (F.when(k == 0, F.concat(s("p_partkey"), F.lit(","), imdb, F.lit(","), tmdb))
            .when(k == 1, F.concat(s("p_partkey"), F.lit(","), imdb, F.lit(",")))
            .when(k == 2, F.concat(s("p_partkey"), F.lit(",,"), tmdb))
            .otherwise(F.concat(F.lit(" "), s("p_partkey"), F.lit(" , "), F.col("p_brand"), F.lit(" ,"),
                                tmdb, F.lit(",extra"))))
    return p.select(line.alias("value"))


def _rating_text() -> Column:
    # quantity/10 printed with one decimal: engine-independent text
    return (F.col("l_quantity") / 10).cast("decimal(6,1)").cast("string")


def _order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = fact(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    return items.join(orders, items.l_orderkey == orders.o_orderkey)


def ratings_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _order_items(spark, sf_dir)
    k = F.col("l_linenumber") % 4
    ts = s(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    line = (F.when(k == 0, F.concat_ws(",", s("o_custkey"), s("l_partkey"), _rating_text(), ts))
            .when(k == 1, F.concat_ws(",", s("o_custkey"), s("l_partkey"), _rating_text()))
            .when(k == 2, F.concat(F.lit(" "), s("o_custkey"), F.lit(" , "), s("l_partkey"), F.lit(" ,"),
                                   s(F.col("l_quantity").cast("int")), F.lit(" ,"), ts, F.lit(",x,y")))
            .otherwise(F.concat_ws(",", s("o_custkey"), s("l_partkey"), _rating_text(), ts, F.lit(""))))
    return j.select(line.alias("value"))


def dcolon_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _order_items(spark, sf_dir)
    ts = s(F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    line = F.concat_ws("::", s("o_custkey"), s("l_partkey"), _rating_text(), ts)
    # every 5th line ends with an empty field, which Java split drops
    line = F.when(F.col("l_linenumber") % 5 == 0, F.concat(line, F.lit("::"))).otherwise(line)
    return j.select(line.alias("value"))


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings lines where some numbers are broken (for the permissive parser)."""
    j = _order_items(spark, sf_dir)
    k = F.col("l_linenumber") % 5
    ts = s(F.col("l_orderkey"))
    line = (F.when(k == 0, F.concat_ws(",", F.concat(F.lit("u"), s("o_custkey")), s("l_partkey"), _rating_text(), ts))
            .when(k == 1, F.concat_ws(",", s("o_custkey"), F.concat(s("l_partkey"), F.lit(".5")), _rating_text(), ts))
            .when(k == 2, F.concat_ws(",", s("o_custkey"), s("l_partkey"), F.lit("n/a"), ts))
            .when(k == 3, F.concat_ws(",", s("o_custkey"), s("l_partkey")))
            .otherwise(F.concat_ws(",", s("o_custkey"), s("l_partkey"), _rating_text(), ts)))
    return j.select(line.alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_frame(fact(spark, sf_dir, "events", ["event_id", "user_id", "value"]))


def message_frame(events: DataFrame) -> DataFrame:
    """Stream message per event (also used on the streaming events source)."""
    return events.select(
        s(F.col("event_id") % 10).alias("key"),
        F.concat_ws("_", s("user_id"), s(F.col("event_id") % 200),
                    s(F.floor("value").cast("int"))).alias("value"))


def rec_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (c.filter(~F.col("c_mktsegment").isin(*NEW_SEGMENTS))
            .select(F.col("c_custkey").cast("int").alias("user_id"),
                    F.lit(FIXTURE_RES).alias("res"),
                    F.when(F.col("c_mktsegment").isin(*OLD_SEGMENTS), F.lit(YESTERDAY))
                    .otherwise(F.lit(TODAY)).alias("day")))


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"),
                    (F.col("vec_id") % 5 == 0).alias("is_user"))


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors(spark, sf_dir).filter("is_user").select("id", "features")


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors(spark, sf_dir).filter("NOT is_user").select("id", "features")
