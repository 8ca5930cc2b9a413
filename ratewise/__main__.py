"""Command line for the four jobs: ``spark-submit ratewise/__main__.py <job> ...`` or
``python -m ratewise <job> ...``.

  etl        --links P --movies P --tags P --ratings P [--database D] [--permissive]
  train      --ratings-table T --model-base DIR [--grid] [--rank R --iters N --reg L]
  recommend  --model PATH --users-table T --out-table T [--k 5] [--cold-start drop|popular]
  stream     --model PATH --ratings-table T --messages DIR --store DIR --checkpoint DIR
             [--marker PATH] [--kafka-servers S --topic T] [--max-offsets N]

Connection settings come from arguments and Spark conf only; nothing is hard-coded.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from ratewise.session import DEFAULT_CONF, checkpoint_dir
    builder = SparkSession.builder.appName("ratewise")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="ratewise")
    sub = ap.add_subparsers(dest="job", required=True)

    etl = sub.add_parser("etl")
    for name in ("links", "movies", "tags", "ratings"):
        etl.add_argument(f"--{name}")
    etl.add_argument("--database")
    etl.add_argument("--permissive", action="store_true")

    tr = sub.add_parser("train")
    tr.add_argument("--ratings-table", required=True)
    tr.add_argument("--model-base", required=True)
    tr.add_argument("--grid", action="store_true")
    tr.add_argument("--rank", type=int)
    tr.add_argument("--iters", type=int)
    tr.add_argument("--reg", type=float)

    rc = sub.add_parser("recommend")
    rc.add_argument("--model", required=True)
    rc.add_argument("--users-table", required=True)
    rc.add_argument("--out-table", required=True)
    rc.add_argument("--k", type=int, default=5)
    rc.add_argument("--cold-start", default="drop", choices=["drop", "popular", "fail"])
    rc.add_argument("--ratings-table")

    st = sub.add_parser("stream")
    st.add_argument("--model", required=True)
    st.add_argument("--ratings-table", required=True)
    st.add_argument("--messages")
    st.add_argument("--kafka-servers")
    st.add_argument("--topic")
    st.add_argument("--max-offsets", type=int)
    st.add_argument("--store", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--marker")
    st.add_argument("--k", type=int, default=5)

    a = ap.parse_args(argv)
    spark = _session()
    from ratewise.plans import jobs

    if a.job == "etl":
        from ratewise.operators.parse import PERMISSIVE, STRICT
        paths = {n: getattr(a, n) for n in ("links", "movies", "tags", "ratings") if getattr(a, n)}
        print(json.dumps(jobs.etl(spark, paths, a.database, parse_mode=PERMISSIVE if a.permissive else STRICT)))
    elif a.job == "train":
        settings = {k: v for k, v in (("rank", a.rank), ("max_iter", a.iters), ("reg", a.reg)) if v is not None}
        print(json.dumps(jobs.split_and_train(spark, a.ratings_table, a.model_base, grid=a.grid, settings=settings)))
    elif a.job == "recommend":
        from ratewise.operators import popular
        from ratewise.sources.models import load_model
        from ratewise.sources.tables import read_table, save_table
        model = load_model(a.model)
        pop = popular.top_items_row(read_table(spark, a.ratings_table), a.k) if a.ratings_table else None
        jobs.batch_recommend(spark, model, read_table(spark, a.users_table), lambda df: save_table(df, a.out_table),
                             k=a.k, cold_start=a.cold_start, popular_items=pop)
    elif a.job == "stream":
        from ratewise.sources.models import load_model
        from ratewise.sources.tables import read_table
        from ratewise.streaming.kafka import kafka_source
        model = load_model(a.model)
        if a.kafka_servers:
            messages = kafka_source(spark, bootstrap_servers=a.kafka_servers, topic=a.topic,
                                    max_offsets_per_trigger=a.max_offsets)
        else:
            messages = spark.readStream.schema("key string, value string").parquet(a.messages)
        q = jobs.stream_recommend(spark, messages.select("value"), model.userFactors, model.itemFactors,
                                  read_table(spark, a.ratings_table, ["movie_id"]), a.checkpoint,
                                  store_path=a.store, k=a.k, marker=a.marker)
        if not a.marker:
            q.awaitTermination()


if __name__ == "__main__":
    main()
