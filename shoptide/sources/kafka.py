"""Kafka reader options. The connector package is supplied on the cluster's class path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(brokers: str, topics: Iterable[str], group_id: str | None = None, **extra: str) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(sorted(topics)),
        "startingOffsets": "latest",
        # Losing messages silently would make the totals wrong.
        "failOnDataLoss": "true",
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return {**options, **extra}


def kafka_stream(
    spark: SparkSession, brokers: str, topics: Iterable[str], group_id: str | None = None, **extra: str
) -> DataFrame:
    """Stream of (topic, value text, timestamp, partition, offset)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, group_id, **extra))
    return message_values(reader.load())


def message_values(df: DataFrame) -> DataFrame:
    """The message text, its arrival time, and its place in the topic."""
    place = [c for c in ("partition", "offset") if c in df.columns]
    return df.select("topic", F.col("value").cast("string").alias("value"), "timestamp", *place)
