"""Streaming readers: Kafka topics in production, folders of JSON lines elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topics(spark: SparkSession, servers: str, topics: list[str], max_offsets: int | None = None) -> DataFrame:
    """Raw messages of Kafka topics from the earliest offset, with their source columns."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.current_timestamp().alias("_consumed_at"),
    )


def read_folder(spark: SparkSession, path: str, topic: str, max_files: int | None = None) -> DataFrame:
    """Messages from files of JSON lines ``{"partition", "offset", "value"}``, shaped like ``read_topics``."""
    reader = spark.readStream.schema("partition INT, offset BIGINT, value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select(
        "value",
        F.lit(topic).alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.current_timestamp().alias("_consumed_at"),
    )


def decode(messages: DataFrame, schema: str) -> DataFrame:
    """Adds ``record``: the message parsed with the declared schema, null fields where it does not fit.

    A ``_corrupt_record STRING`` field in the schema receives the text of messages that do not parse.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return messages.withColumn("record", F.from_json("value", schema, options))
