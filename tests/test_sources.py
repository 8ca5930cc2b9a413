import math

from pyspark.sql import functions as F

from ratewise.operators.metrics import match_truth, ml_metric, regression_metrics
from ratewise.session import scratch_path
from ratewise.sources.jdbc import classify_statement, existing_keys, staging_name, top_ids, upsert_statements
from ratewise.sources.tables import cut_lineage, export_rows, persist
from ratewise.sources.text import read_text_dataset
from ratewise.streaming.job import console


def test_top_ids_explicit_order(spark):
    top_movie = spark.createDataFrame([(1, 30, 3), (2, 10, 1), (3, 20, 2)], "rank_id int, movie_id int, pos int")
    assert [r.movie_id for r in top_ids(top_movie, 2, order_by="pos").collect()] == [10, 20]


def test_existing_keys_is_semi_join(spark):
    target = spark.createDataFrame([(1, "a", "d1"), (1, "b", "d2"), (2, "c", "d3")], "user_id int, res string, day string")
    incoming = spark.createDataFrame([(1,), (3,)], "user_id int")
    assert sorted(tuple(r) for r in existing_keys(target, incoming).collect()) == [(1, "d1"), (1, "d2")]


def test_tables_helpers(spark):
    df = spark.range(10)
    assert persist(df).count() == 10
    frozen = cut_lineage(df.withColumn("x", F.col("id") * 2))
    assert "LogicalRDD" in frozen._jdf.queryExecution().analyzed().toString()
    assert sorted(r.id for r in export_rows(df)) == list(range(10))


def test_text_dataset(spark):
    path = scratch_path(spark, "t-text")
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(path)
    assert sorted(r.value for r in read_text_dataset(spark, path).collect()) == ["a", "b"]


def test_ml_metric_matches_sql_form(spark):
    pred = spark.createDataFrame([(1, 1, 3.0), (1, 2, 2.0), (2, 1, 5.0)], "user_id int, movie_id int, prediction double")
    truth = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.5), (2, 1, 4.0)], "user_id int, movie_id int, rating double")
    m = match_truth(pred, truth)
    sql = regression_metrics(m).first()
    assert math.isclose(ml_metric(m, "rmse"), sql.rmse)
    assert math.isclose(ml_metric(m, "mae"), sql.mae)
    assert math.isclose(ml_metric(m, "r2"), sql.r2)


def test_console_sink_runs(spark):
    d = scratch_path(spark, "t-console-in")
    spark.createDataFrame([("k", "1_2_3")], "key string, value string").write.parquet(d)
    src = spark.readStream.schema("key string, value string").parquet(d)
    q = console(src, scratch_path(spark, "t-console-ckpt"), available_now=True)
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 1


def test_default_format_save(spark):
    """K3: no format given, the session's default is used."""
    from ratewise.sources.tables import read_table, save_table
    df = spark.range(5).selectExpr("CAST(id AS INT) AS user_id", "id * 1.5 AS rating")
    save_table(df, "ratewise_default_format", fmt=None, replace=True)
    assert sorted(map(tuple, read_table(spark, "ratewise_default_format").collect())) == sorted(map(tuple, df.collect()))
    told = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED ratewise_default_format").collect()}
    assert told["Provider"].lower() == spark.conf.get("spark.sql.sources.default")


def test_current_day_text(spark):
    """the run day, when none is given, is today as yyyy-MM-dd."""
    from ratewise.functions.codec import day_text
    before = spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    got = spark.range(1).select(day_text(None).alias("d")).first()["d"]
    assert before <= got <= spark.sql("SELECT CAST(current_date() AS STRING)").first()[0] and len(got) == 10


def test_random_split_is_a_partition(spark):
    """Seeded, repeatable, every row on exactly one side, about the weights."""
    from ratewise.operators.split import random_split
    df = spark.range(4000).repartition(3).cache()
    a, b = random_split(df, (0.8, 0.2), seed=3)
    left, right = ({r.id for r in side.collect()} for side in (a, b))
    assert not left & right and left | right == set(range(4000)) and 0.75 < len(left) / 4000 < 0.85
    assert {r.id for r in random_split(df, (0.8, 0.2), seed=3)[0].collect()} == left


def test_statements_follow_the_rule(spark):
    """S6/K8 in a database: the three statements, run by SQLite in memory, against the Spark form."""
    import random
    import sqlite3

    from ratewise.operators.upsert import apply_actions, classify
    rnd = random.Random(4)
    target = [(u, f"old{u}", rnd.choice(["d1", "d2", "today", None])) for u in range(40)] + [(3, "twice", "d0"), (4, "twice", "d0")]
    incoming = [(u, f"new{u}") for u in rnd.sample(range(60), 35)]
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE rec_user (user_id INT, res TEXT, day TEXT)")
    stage = staging_name("rec_user_stage", 7)
    assert stage == "rec_user_stage_7" and staging_name("s", None) == "s"
    con.execute(f"CREATE TABLE {stage} (user_id INT, res TEXT, day TEXT, action TEXT)")
    con.executemany("INSERT INTO rec_user VALUES (?, ?, ?)", target)
    con.executemany(f"INSERT INTO {stage} VALUES (?, ?, 'today', 'update')", incoming)
    con.execute(classify_statement("rec_user", stage))
    actions = classify(spark.createDataFrame(incoming, "user_id int, res string"),
                       spark.createDataFrame(target, "user_id int, res string, day string"), "today")
    assert dict(con.execute(f"SELECT user_id, action FROM {stage}")) == {r.user_id: r.action for r in actions.collect()}
    for sql in upsert_statements("rec_user", stage):
        con.execute(sql)
    after = apply_actions(spark.createDataFrame(target, "user_id int, res string, day string"), actions)
    assert set(con.execute("SELECT * FROM rec_user")) == set(map(tuple, after.collect()))


def test_stored_rows_are_read_by_column_and_filter(spark):
    """What several passes read is a table: the same rows, nulls and copies too, pruned and filtered by the reader."""
    from ratewise.sources.tables import stored
    rows = [(1, 2, 0.1 + 0.2), (1, 2, 0.1 + 0.2), (None, 3, None), (4, None, float("inf"))]
    df = spark.createDataFrame(rows, "user_id int, movie_id int, rating double")
    got = stored(df, "t-stored")
    assert got.schema == df.schema and sorted(got.collect(), key=str) == sorted(df.collect(), key=str)
    plan = got.filter("rating > 1").select("movie_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rating,1.0)" in plan and "ReadSchema: struct<movie_id:int,rating:double>" in plan
