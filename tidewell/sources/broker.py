"""Kafka source and sink.  The connector jar comes with the cluster; without it Spark reports
that the data source is unknown.  Record building and parsing live in ``functions.records``
and work on any frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.records import keyed_records


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming ``key, value, topic, partition, offset, timestamp``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def publish(df: DataFrame, servers: str, topic: str, **key_options) -> None:
    """Send every row as a keyed JSON record; the connector partitions by key."""
    keyed_records(df, **key_options).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "kafka.acks", "all"
    ).option("topic", topic).save()


def publish_stats(records: DataFrame) -> DataFrame:
    """``messages, bytes, keys`` of keyed records."""
    return records.agg(
        F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
        F.count_distinct("key").alias("keys"),
    )
