"""Kafka topics, and files that have the columns of Kafka records.

The broker connector is a package to add at submit time (spark-sql-kafka-0-10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from basketry import schemas
from basketry.config import Settings


def kafka_options(
    settings: Settings,
    topics: Sequence[str],
    starting_offsets: str,
    tolerate_loss: bool = True,
    group: str | None = None,
) -> dict[str, str]:
    """Reader options. The starting point is always named: `earliest` or `latest`."""
    options = {
        "kafka.bootstrap.servers": settings.kafka_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(not tolerate_loss).lower(),
    }
    if group:
        options["kafka.group.id"] = group
    if settings.kafka_min_partitions:
        options["minPartitions"] = str(settings.kafka_min_partitions)
    if settings.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def read_topics(
    spark: SparkSession,
    settings: Settings,
    topics: Sequence[str],
    starting_offsets: str,
    tolerate_loss: bool = True,
    group: str | None = None,
) -> DataFrame:
    options = kafka_options(settings, topics, starting_offsets, tolerate_loss, group)
    return spark.readStream.format("kafka").options(**options).load()


def read_cdc(spark: SparkSession, settings: Settings) -> DataFrame:
    """All change topics from the first retained record."""
    return read_topics(spark, settings, settings.cdc_topics(), "earliest", tolerate_loss=False)


def read_record_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over Parquet files that hold Kafka-shaped records."""
    reader = spark.readStream.schema(schemas.KAFKA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
