"""Streaming sources of topic records: ``value, topic, partition, offset``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.schemas import TOPIC_SOURCES


def kafka_records(
    spark: SparkSession,
    servers: str,
    topics: Iterable[str] = tuple(TOPIC_SOURCES),
    **options: str,
) -> DataFrame:
    """Kafka topics from the earliest offset; later starts resume from the checkpoint.

    Needs the Kafka connector on the class path. ``minPartitions`` and
    ``maxOffsetsPerTrigger`` are passed through ``options``.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        **options,
    }
    stream = spark.readStream.format("kafka").options(**settings).load()
    return stream.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def file_records(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Files of lines below ``topic=<name>/`` folders, the file twin of a set of topics."""
    stream = (
        spark.readStream.format("text")
        .schema("value string, topic string")
        .options(**options)
        .load(path)
    )
    return with_constant_position(stream)


def collection_records(spark: SparkSession, lines: Iterable[str], topic: str) -> DataFrame:
    """A given list of lines as a static frame of records."""
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    return with_constant_position(rows.withColumn("topic", F.lit(topic)))


def with_constant_position(records: DataFrame) -> DataFrame:
    return records.select(
        "value",
        "topic",
        F.lit(0).cast("int").alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
    )
