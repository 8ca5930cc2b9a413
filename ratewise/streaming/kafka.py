"""Kafka source and sink (S8-S10, T3, T8, K10, T11) through Spark's built-in connector.

The connector jar (``spark-sql-kafka-0-10``) must be on the classpath at run time; these helpers
only build the reader / writer.  Offsets are tracked by the query checkpoint, not by ZooKeeper:
``startingOffsets`` applies to the first run only, later runs resume from the checkpoint.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Producer settings of the reference feeder.
PRODUCER_DEFAULTS = {
    "acks": "all",
    "retries": "1",
    "batch.size": "16384",
    "linger.ms": "1",
    "buffer.memory": "33554432",
}


def rate_limit(max_rate_per_partition: int, batch_seconds: int, partitions: int) -> int:
    """The reference's per-partition, per-second cap as a per-trigger offset cap."""
    return max_rate_per_partition * batch_seconds * partitions


def kafka_source_options(bootstrap_servers: str, topic: str, starting_offsets="earliest",
                         max_offsets_per_trigger: int | None = None, group_id: str | None = None,
                         extra: dict | None = None) -> dict:
    """Reader options.  ``starting_offsets`` is "earliest", "latest" or a
    ``{topic: {partition: offset}}`` dict (an explicit resume point)."""
    if isinstance(starting_offsets, dict):
        starting_offsets = json.dumps({t: {str(p): int(o) for p, o in parts.items()}
                                       for t, parts in starting_offsets.items()})
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def kafka_source(spark: SparkSession, **kw) -> DataFrame:
    """Messages as ``key, value`` strings plus ``topic, partition, offset``."""
    raw = spark.readStream.format("kafka").options(**kafka_source_options(**kw)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                      "topic", "partition", "offset")


def kafka_sink_options(bootstrap_servers: str, topic: str, producer: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    for k, v in {**PRODUCER_DEFAULTS, **(producer or {})}.items():
        opts[f"kafka.{k}"] = str(v)
    return opts


def write_kafka(messages: DataFrame, bootstrap_servers: str, topic: str, producer: dict | None = None) -> None:
    """Batch write of ``key, value`` records (flushed and closed by the connector)."""
    (messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
     .write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, producer)).save())


def feed_messages(train: DataFrame, seed: int | None = None) -> DataFrame:
    """T11 step 1 (O2 + P9): one ``key, value`` record per training row; the key is the
    reference's random 0..9 when a ``seed`` is given, else the deterministic default."""
    from ratewise.functions.codec import encode_message, random_key
    key, value = encode_message("user_id", "movie_id", "rating",
                                key=random_key(seed) if seed is not None else None)
    return train.select(key, value)


def feed_topic(train: DataFrame, bootstrap_servers: str, topic: str, users_table: str | None = None,
               producer: dict | None = None, seed: int | None = None) -> None:
    """Write the training rows to a topic (K10), then keep them as a table (K3)."""
    write_kafka(feed_messages(train, seed), bootstrap_servers, topic, producer)
    if users_table:
        train.write.mode("overwrite").saveAsTable(users_table)
