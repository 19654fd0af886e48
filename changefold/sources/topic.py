"""The change topic as a stream. Needs Spark's Kafka package on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, value binary"


def topic_options(servers: str, topics: str | Sequence[str], starting_offsets: str = "earliest") -> dict[str, str]:
    """Reader options. `topics` is a list or comma-separated text; an empty one is refused."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    names = [name.strip() for name in names if name.strip()]
    if not names:
        raise ValueError("name at least one topic")
    if not servers:
        raise ValueError("name at least one broker")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting_offsets,
    }


def read_change_topic(spark: SparkSession, servers: str, topics: str | Sequence[str], **options: str) -> DataFrame:
    """Messages of the topics from their start; further reader options pass through."""
    options = {**topic_options(servers, topics), **options}
    return spark.readStream.format("kafka").options(**options).load().select("topic", "partition", "offset", "value")
