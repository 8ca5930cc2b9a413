import os
import tempfile
import threading
import time

import pytest

from ratewise.operators import popular
from ratewise.operators.upsert import UserTable, apply_actions, classify
from ratewise.session import scratch_path
from ratewise.sources.jdbc import jdbc_options, upsert_statements
from ratewise.streaming import (
    RecommendBatch, batch_counts, batch_users, file_stream, kafka_sink_options, kafka_source_options, rate_limit,
    run_until_marker, start,
)

DAY = "2024-01-31"


def frames(spark):
    target = spark.createDataFrame([(1, "a", "2024-01-30"), (2, "b", DAY), (2, "c", "2024-01-29")],
                                   "user_id int, res string, day string")
    incoming = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "user_id int, res string")
    return target, incoming


def test_classify_rule(spark):
    target, incoming = frames(spark)
    got = {r.user_id: r.action for r in classify(incoming, target, DAY).collect()}
    assert got == {1: "update", 2: "skip", 3: "insert"}


def test_apply_actions(spark):
    target, incoming = frames(spark)
    after = sorted(tuple(r) for r in apply_actions(target, classify(incoming, target, DAY)).collect())
    assert after == [(1, "x", DAY), (2, "b", DAY), (2, "c", "2024-01-29"), (3, "z", DAY)]


def _rows(table):
    return sorted(map(tuple, table.state().collect()))


def test_table_replay_is_idempotent(spark):
    target, incoming = frames(spark)
    table = UserTable(spark, scratch_path(spark, "t-table")).init(target)
    assert _rows(table) == [(1, "a", "2024-01-30"), (2, "b", DAY)]      # one row per user, the latest day
    table.write_batch(1, incoming, DAY)
    first = _rows(table)
    assert first == [(1, "x", DAY), (2, "b", DAY), (3, "z", DAY)]
    table.write_batch(1, incoming, DAY)          # replay of the same batch
    assert _rows(table) == first
    table.write_batch(2, incoming, DAY)          # a later batch the same day: all skipped
    assert _rows(table) == first
    table.write_batch(3, incoming, "2024-02-01")
    assert _rows(table) == [(1, "x", "2024-02-01"), (2, "y", "2024-02-01"), (3, "z", "2024-02-01")]


def test_table_from_nothing_and_without_days(spark):
    table = UserTable(spark, scratch_path(spark, "t-none"))
    assert _rows(table) == []
    table.write_batch(0, spark.createDataFrame([(4, "q")], "user_id int, res string"), DAY)
    assert _rows(table) == [(4, "q", DAY)]
    table.init(spark.createDataFrame([(5, "old", None)], "user_id int, res string, day string"))
    table.write_batch(1, spark.createDataFrame([(5, "new")], "user_id int, res string"), DAY)
    assert (5, "new", DAY) in _rows(table)


def test_no_files_but_the_data(spark):
    """Nothing beside parquet: no marks, no pointers."""
    target, incoming = frames(spark)
    table = UserTable(spark, scratch_path(spark, "t-plain")).init(target)
    table.write_batch(0, incoming, DAY, run="file:/some/checkpoint")
    local = table.path.replace("file:", "")
    names = {n for _, _, files in os.walk(local) for n in files if not n.startswith(".")}
    assert all(n.startswith("part-") or n == "_SUCCESS" for n in names)
    assert sorted(os.listdir(local)) == ["batches", "table"]


def test_recover_puts_back_a_lost_bucket(spark):
    """A commit that died between removing a bucket and putting the new one in its place."""
    base = spark.range(500).selectExpr("CAST(id AS INT) AS user_id", "'a' AS res", "'2024-01-30' AS day")
    table = UserTable(spark, scratch_path(spark, "t-lost"), buckets=8).init(base)
    incoming = spark.createDataFrame([(5, "x"), (900, "y")], "user_id int, res string")
    table.write_batch(0, incoming, DAY, run="r")
    want = _rows(table)
    lost = incoming.select(table.bucket()).first()[0]
    top = os.path.join(table.table.replace("file:", ""), "n_buckets=8")
    os.rename(os.path.join(top, f"bucket={lost}"), os.path.join(tempfile.mkdtemp(), "gone"))
    assert len(_rows(table)) < len(want)
    assert UserTable(spark, table.path).recover("another run") == 0
    assert UserTable(spark, table.path).recover("r") == 1
    assert _rows(table) == want
    assert table.recover("r") == 0


def _message_dir(spark, batches):
    d = tempfile.mkdtemp(prefix="ratewise-msgs-")
    for i, vals in enumerate(batches):
        spark.createDataFrame([(str(j % 10), v) for j, v in enumerate(vals)], "key string, value string") \
            .coalesce(1).write.parquet(os.path.join(d, f"b{i}"))
    return d


def test_stream_recommend_end_to_end(spark):
    uf = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "id int, features array<float>")
    vf = spark.createDataFrame([(100, [1.0, 0.0]), (101, [0.0, 1.0]), (102, [0.5, 0.5])], "id int, features array<float>")
    ratings = spark.createDataFrame([(1, 101), (2, 101), (3, 100)], "user_id int, movie_id int")
    pop = popular.top_items_row(ratings, 2)
    d = _message_dir(spark, [["7_1_3", "9_2_4", "7_5_1"], ["8_1_1", "9_2_2"]])
    schema = "key string, value string"
    store = UserTable(spark, scratch_path(spark, "t-rec")).init(
        spark.createDataFrame([(9, "old", "2024-01-30")], "user_id int, res string, day string"))
    fn = RecommendBatch(uf, vf, pop, store, k=2, day=DAY)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "*"))
    counts = scratch_path(spark, "t-counts")
    q = start(src, fn, scratch_path(spark, "t-ckpt"), available_now=True, counts_path=counts)
    q.awaitTermination()
    assert sorted(map(tuple, batch_counts(spark, counts).collect())) == [(0, 3), (1, 2)]     # A11: rows per micro-batch
    # every batch read its source once: the counts came with the pass that made its users
    assert [p.numInputRows for p in q.recentProgress if p.numInputRows] == [3, 2]
    state = {r.user_id: (r.res, r.day) for r in store.state().collect()}
    assert state == {7: ("100_102", DAY), 8: ("101_102", DAY), 9: ("101_100", DAY)}
    # a restart with a new checkpoint replays both batches: nothing changes
    fn2 = RecommendBatch(uf, vf, pop, UserTable(spark, store.path), k=2, day=DAY, run="again")
    src2 = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "*"))
    start(src2, fn2, scratch_path(spark, "t-ckpt2"), available_now=True).awaitTermination()
    assert {r.user_id: (r.res, r.day) for r in store.state().collect()} == state


def test_offsets_over_a_restart(spark):
    from ratewise.streaming.offsets import OffsetLog, gaps, resume
    d = _message_dir(spark, [["1_1_1"], ["2_2_2", "3_3_3"]])
    ckpt, path = scratch_path(spark, "t-off-ckpt"), scratch_path(spark, "t-off")

    def run():
        src = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "*"))
        with OffsetLog(spark, path, run="r") as log:
            log.follow(start(src, lambda b, i: b.count(), ckpt, available_now=True))
        return log

    run()
    spark.createDataFrame([("0", "4_4_4")], "key string, value string").coalesce(1).write.parquet(os.path.join(d, "b9"))
    log = run()
    rows = log.table().orderBy("batch_id").collect()
    assert [(r.batch_id, r.n_rows) for r in rows] == [(0, 1), (1, 2), (2, 1)]
    assert rows[0].start_offset is None and all(a.end_offset == b.start_offset for a, b in zip(rows, rows[1:]))
    assert gaps(log.table()).count() == 0
    lost = log.table().filter("batch_id <> 1")
    assert [r.batch_id for r in gaps(lost).collect()] == [2]
    assert resume(log.table(), "other") == {"startingOffsets": "earliest"}
    kafka = spark.createDataFrame([(0, '{"t":{"0":5}}', '{"t":{"0":9}}', 4, "k", 0), (0, '{"t":{"0":9}}', '{"t":{"0":12}}', 3, "k", 1)],
                                  "source int, start_offset string, end_offset string, n_rows bigint, run string, batch_id bigint")
    assert resume(kafka, "k") == {"startingOffsets": '{"t": {"0": 12}}'}
    assert resume(kafka, "k", replay_last=True) == {"startingOffsets": '{"t": {"0": 9}}'}


def test_model_only_stream_fails_on_an_unknown_user(spark):
    from pyspark.errors import StreamingQueryException
    uf = spark.createDataFrame([(7, [1.0, 0.0])], "id int, features array<float>")
    vf = spark.createDataFrame([(100, [1.0, 0.0])], "id int, features array<float>")
    d = _message_dir(spark, [["7_1_3"], ["7_1_3", "9_2_4"]])
    got = []
    fn = RecommendBatch(uf, vf, None, None, k=1, cold_start="fail", sink=lambda recs, i: got.append((i, sorted(map(tuple, recs.collect())))))
    src = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 1).parquet(os.path.join(d, "*"))
    with pytest.raises(StreamingQueryException, match="user has no factors: 9"):
        start(src, fn, scratch_path(spark, "t-fail"), available_now=True).awaitTermination()
    assert got == [(0, [(7, "100")])]


def test_batch_users_distinct(spark):
    df = spark.createDataFrame([("7_1_3",), ("7_2_3",), ("9_1_1",)], "value string")
    assert sorted(r.user_id for r in batch_users(df).collect()) == [7, 9]


def test_marker_file_stops_query(spark):
    d = _message_dir(spark, [["1_1_1"]])
    src = file_stream(spark, os.path.join(d, "b0"), "*.parquet", "key string, value string")
    q = start(src, lambda df, i: None, scratch_path(spark, "t-marker"), processing_time="1 second")
    marker = os.path.join(d, "stop")
    threading.Timer(2.0, lambda: open(marker, "w").close()).start()
    t0 = time.time()
    assert run_until_marker(spark, q, marker, poll_seconds=0.5, max_polls=60) is True
    assert not q.isActive and time.time() - t0 < 30


def test_feed_messages(spark):
    from ratewise.streaming import feed_messages
    train = spark.createDataFrame([(7, 3, 4.5), (1, 2, 1.0)], "user_id int, movie_id int, rating double")
    got = sorted(tuple(r) for r in feed_messages(train).collect())
    assert got == [("0", "7_3_4.5"), ("3", "1_2_1.0")]   # key = (31*user + movie) mod 10
    keys = [r.key for r in feed_messages(train, seed=1).collect()]
    assert all(k in [str(i) for i in range(10)] for k in keys)


def test_bucketed_table_roundtrip(spark):
    from ratewise.sources.tables import read_table, save_table
    df = spark.range(100).selectExpr("CAST(id AS INT) AS user_id", "id * 2 AS v")
    save_table(df, "ratewise_bucketed", replace=True, path=scratch_path(spark, "t-bucket"), bucket_by=(4, "user_id"))
    back = read_table(spark, "ratewise_bucketed")
    assert back.count() == 100
    plan = back.groupBy("user_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_option_builders():
    assert rate_limit(100, 3, 4) == 1200
    o = kafka_source_options("h:9092", "ratings", {"ratings": {0: 5, 1: 7}}, max_offsets_per_trigger=1200)
    assert o["startingOffsets"] == '{"ratings": {"0": 5, "1": 7}}' and o["maxOffsetsPerTrigger"] == "1200"
    s = kafka_sink_options("h:9092", "ratings")
    assert s["kafka.acks"] == "all" and s["topic"] == "ratings"
    j = jdbc_options("jdbc:x", "rec_user", partition_column="user_id", lower_bound=1, upper_bound=9,
                     num_partitions=3, batchsize=1000)
    assert j["numPartitions"] == "3" and j["batchsize"] == "1000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="user_id")
    sql = upsert_statements("rec_user", "rec_user_stage")
    assert sql[0].startswith("UPDATE rec_user") and sql[1].startswith("INSERT INTO rec_user")


def test_batch_reads_and_writes_only_its_buckets(spark):
    base = spark.range(2000).selectExpr("CAST(id AS INT) AS user_id", "'a' AS res", "'2024-01-30' AS day")
    path = scratch_path(spark, "t-buckets")
    UserTable(spark, path, buckets=16).init(base)
    table = UserTable(spark, path)             # the count is the table's own
    assert table.buckets == 16
    incoming = spark.createDataFrame([(5, "x"), (9999, "y")], "user_id int, res string")
    buckets = sorted({r[0] for r in incoming.select(table.bucket()).collect()})
    plan = table.stored(buckets)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]

    def files():
        top = os.path.join(table.table.replace("file:", ""), "n_buckets=16")
        return {b: sorted(os.listdir(os.path.join(top, b))) for b in os.listdir(top)}

    before = files()
    table.write_batch(1, incoming, DAY, buckets=buckets)
    assert {b for b, names in files().items() if names != before[b]} == {f"bucket={b}" for b in buckets}
    after = {r.user_id: r.res for r in table.state().collect()}
    assert len(after) == 2001 and after[5] == "x" and after[9999] == "y" and after[6] == "a"


def test_stored_user_without_a_day_is_updated(spark):
    from ratewise.operators.upsert import classify
    target = spark.createDataFrame([(1, "a", None), (2, "a", "2020-01-01"), (3, "a", "2020-01-02")], "user_id int, res string, day string")
    incoming = spark.createDataFrame([(i, "b") for i in (1, 2, 3, 4)], "user_id int, res string")
    got = {r["user_id"]: r["action"] for r in classify(incoming, target, "2020-01-02").collect()}
    assert got == {1: "update", 2: "update", 3: "skip", 4: "insert"}


@pytest.mark.parametrize("name", ["stream_failed_batch", "stream_restart"])
def test_restarted_queries_share_the_popular_ids(spark, tmp_path, monkeypatch, name):
    """All ratings are read once for the popular ids, not once for each query started."""
    from ratewise.plans import catalog
    d = str(tmp_path)
    for table, rows, schema in [
        ("orders", [(o, 1 + o % 3) for o in range(12)], "o_orderkey bigint, o_custkey bigint"),
        ("lineitem", [(o, 100 + p, 10.0) for o in range(12) for p in range(1 + o % 7)], "l_orderkey bigint, l_partkey bigint, l_quantity double"),
        ("customer", [(1, "BUILDING"), (2, "HOUSEHOLD"), (3, "MACHINERY")], "c_custkey bigint, c_mktsegment string"),
        ("events", [(i, f"2024-01-01 00:00:{i:02d}", 1 + i % 6, 1.5) for i in range(24)], "event_id bigint, ts string, user_id bigint, value double"),
        ("embeddings", [(i, [float(i % 5), 1.0]) for i in range(11)], "vec_id bigint, embedding array<float>"),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{table}.parquet")
    seen, ratings = [], catalog.V.ratings
    monkeypatch.setattr(catalog.V, "ratings", lambda *a: seen.append(a) or ratings(*a))
    rows = {r.user_id: (r.res, r.day) for r in catalog.QUERIES[name](spark, d).collect()}
    assert len(seen) == 1
    pop = "100_101_102_103_104"
    assert rows == {1: (pop, catalog.V.TODAY), 2: (catalog.V.FIXTURE_RES, catalog.V.TODAY), 3: (pop, catalog.V.TODAY),
                    4: (pop, catalog.V.TODAY), 5: ("1_2_3_4_6", catalog.V.TODAY), 6: (pop, catalog.V.TODAY)}
