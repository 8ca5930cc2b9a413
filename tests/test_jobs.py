import os

from pyspark.sql import functions as F

from ratewise.plans import jobs
from ratewise.plans import views as V
from ratewise.session import scratch_path

from conftest import SF0001


def test_four_jobs_chain(spark):
    base = scratch_path(spark, "t-jobs")
    paths = {}
    for name, view in (("links", V.links_lines), ("movies", V.movies_lines), ("tags", V.tags_lines),
                       ("ratings", V.ratings_lines)):
        p = os.path.join(base, name)
        view(spark, SF0001).write.text(p)
        paths[name] = p
    tables = jobs.etl(spark, paths)
    assert spark.table(tables["movies"]).count() > 0
    assert spark.table(tables["ratings"]).count() == V.ratings_lines(spark, SF0001).filter(
        F.col("value").rlike(r"^[^,]*,[^,]*,[^,]*,.+")).count()

    out = jobs.split_and_train(spark, tables["ratings"], os.path.join(base, "models"),
                               settings={"rank": 3, "max_iter": 2})
    assert "/i_2_l0_0.006_" in out["model_path"]
    from ratewise.sources.models import load_model
    model = load_model(out["model_path"])

    got = {}
    users = spark.table(out["train"]).select("user_id")
    res = jobs.batch_recommend(spark, model, users, lambda df: got.setdefault("n", df.count()), k=3)
    assert got["n"] == model.userFactors.join(users.withColumnRenamed("user_id", "id"), "id", "left_semi").count()
    assert res.filter(~F.col("res").rlike(r"^movie_id=\d+,rating=[-0-9.E]+(\|movie_id=\d+,rating=[-0-9.E]+){2}$")).count() == 0

    msgs = V.message_frame(spark.read.parquet(f"{SF0001}/events.parquet"))
    msg_dir = os.path.join(base, "msgs")
    msgs.write.parquet(msg_dir)
    stream = spark.readStream.schema("key string, value string").parquet(msg_dir)
    store = os.path.join(base, "rec_user")
    q = jobs.stream_recommend(spark, stream, model.userFactors, model.itemFactors,
                              spark.table(tables["ratings"]), scratch_path(spark, "t-jobs-ckpt"),
                              store_path=store, available_now=True)
    q.awaitTermination()
    from ratewise.operators.upsert import UserTable
    state = UserTable(spark, store).state()
    assert state.count() == msgs.select(F.split("value", "_")[0]).distinct().count()
