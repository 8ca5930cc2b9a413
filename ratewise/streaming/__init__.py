from ratewise.streaming.job import (
    RecommendBatch, batch_counts, batch_users, distinct_users_per_batch, file_stream, path_exists,
    run_until_marker, start, stop_on_signal,
)
from ratewise.streaming.offsets import OffsetLog
from ratewise.streaming.kafka import (
    feed_messages, feed_topic, kafka_sink_options, kafka_source, kafka_source_options, rate_limit, write_kafka,
)

__all__ = [
    "OffsetLog", "RecommendBatch", "batch_counts", "batch_users", "distinct_users_per_batch", "file_stream",
    "path_exists", "run_until_marker", "start", "stop_on_signal", "kafka_sink_options", "kafka_source",
    "kafka_source_options", "rate_limit", "write_kafka", "feed_messages", "feed_topic",
]
