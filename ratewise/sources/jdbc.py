"""JDBC tables (S4-S6, K4-K9) through Spark's JDBC data source.

Reads are split by ``partitionColumn/lowerBound/upperBound/numPartitions`` when given (S5);
writes go out from every task with ``batchsize`` rows per round trip and one transaction per
partition (K5, K9).  The database is an outside service: nothing here starts one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators.upsert import SKIP

# Fixed value: rows per JDBC round trip (the reference flushes every 1000 rows).
BATCH_SIZE = 1000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetchsize: int | None = None, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 batchsize: int | None = None, isolation_level: str | None = None) -> dict:
    opts = {"url": url, "dbtable": table}
    for k, v in (("user", user), ("password", password), ("driver", driver), ("fetchsize", fetchsize),
                 ("partitionColumn", partition_column), ("lowerBound", lower_bound),
                 ("upperBound", upper_bound), ("numPartitions", num_partitions),
                 ("batchsize", batchsize), ("isolationLevel", isolation_level)):
        if v is not None:
            opts[k] = str(v)
    if partition_column and (lower_bound is None or upper_bound is None or num_partitions is None):
        raise ValueError("partitionColumn needs lowerBound, upperBound and numPartitions")
    return opts


def read_jdbc(spark: SparkSession, **opts) -> DataFrame:
    """Whole-table read (split when partition options are given)."""
    return spark.read.format("jdbc").options(**jdbc_options(**opts)).load()


def top_ids(df: DataFrame, k: int = 5, column: str | None = None, order_by: str | None = None) -> DataFrame:
    """``k`` ids from the table's 2nd column, in an explicit order (the reference takes
    storage order)."""
    col = column or df.columns[1]
    order = F.col(order_by) if order_by else F.col(col)
    return df.select(F.col(col).cast("int").alias("movie_id"), order.alias("_o")).orderBy("_o").limit(k).drop("_o")


def existing_keys(target: DataFrame, incoming: DataFrame, key: str = "user_id") -> DataFrame:
    """``select user_id, day from rec_user where user_id in (...)`` as a semi join; with a
    JDBC target the key filter runs against the whole table scan, never as a giant IN list."""
    return target.select(key, "day").join(incoming.select(key).distinct(), key, "left_semi")


def jdbc_append(df: DataFrame, url: str, table: str, props: dict | None = None, batchsize: int = BATCH_SIZE,
                num_partitions: int | None = None) -> None:
    """K4/K5/K6: append rows (``num_partitions`` caps concurrent connections)."""
    if num_partitions:
        df = df.coalesce(num_partitions)
    opts = {**(props or {}), "batchsize": str(batchsize)}
    df.write.mode("append").format("jdbc").option("url", url).option("dbtable", table).options(**opts).save()


def classify_statement(table: str, staging: str, key: str = "user_id") -> str:
    """S6/J4 in the database: the action of every staged row, by key lookups in the target.  Only
    the batch's keys are looked up; the target is never read out."""
    known = f"EXISTS (SELECT 1 FROM {table} t WHERE t.{key} = {staging}.{key}"
    return (f"UPDATE {staging} SET action = CASE WHEN NOT {known}) THEN 'insert' "
            f"WHEN {known} AND t.day = {staging}.day) THEN 'skip' ELSE 'update' END")


def upsert_statements(table: str, staging: str, key: str = "user_id") -> list[str]:
    """K7/K8 set-based DML: update every target row of a staged 'update' user, then insert the
    staged 'insert' users.  Runs inside the database, one transaction."""
    return [
        f"UPDATE {table} SET res = (SELECT s.res FROM {staging} s WHERE s.{key} = {table}.{key} AND s.action = 'update'), "
        f"day = (SELECT s.day FROM {staging} s WHERE s.{key} = {table}.{key} AND s.action = 'update') "
        f"WHERE {key} IN (SELECT {key} FROM {staging} WHERE action = 'update')",
        f"INSERT INTO {table} ({key}, res, day) SELECT {key}, res, day FROM {staging} WHERE action = 'insert'",
    ]


def staging_name(staging: str, batch_id: int | None) -> str:
    """A staging table of its own for each batch: a batch that died leaves nothing to the next."""
    return staging if batch_id is None else f"{staging}_{batch_id}"


def _connection(spark: SparkSession, url: str, props: dict):
    jvm = spark.sparkContext._jvm
    if props.get("driver"):     # DriverManager knows only drivers whose class has been loaded
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(props["driver"], True, loader)
    info = jvm.java.util.Properties()
    for k, v in props.items():
        info.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, info)


def jdbc_upsert(spark: SparkSession, rows: DataFrame, url: str, table: str, staging: str, props: dict | None = None,
                key: str = "user_id", batch_id: int | None = None) -> None:
    """K8 into a database: stage ``rows`` (key, res, day; one row per key) with the JDBC writer
    (distributed), then classify, update and insert by set-based statements in one transaction.
    Rows that already have an ``action`` are taken as classified.  Errors roll back and raise."""
    props = props or {}
    classified = "action" in rows.columns
    if classified:
        rows = rows.filter(F.col("action") != SKIP)
    staged = rows.select(key, "res", "day", F.col("action") if classified else F.lit("update").alias("action"))
    name = staging_name(staging, batch_id)
    (staged.write.mode("overwrite").format("jdbc").option("url", url).option("dbtable", name)
     .option("truncate", "true").options(**props).save())
    conn = _connection(spark, url, props)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        for sql in ([] if classified else [classify_statement(table, name, key)]) + upsert_statements(table, name, key):
            stmt.executeUpdate(sql)
        conn.commit()
        if name != staging:
            stmt.executeUpdate(f"DROP TABLE {name}")
            conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
