"""Bronze: every parsed event, appended to date-partitioned Parquet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketry.functions.dates import between_days
from basketry.sources.files import read_dataset
from basketry.streaming.runs import check_pairing

DATE_PARTS = ("year", "month", "day")


def append_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    partitions: tuple[str, ...] = DATE_PARTS,
    trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start the append. No watermark here: events too late for the metrics are kept.

    Without a trigger the query takes all that is there and ends.
    """
    check_pairing(events.sparkSession, path, checkpoint)
    writer = events.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def compact_days(
    spark: SparkSession, live: str, compacted: str, schema: StructType, first: dt.date, last: dt.date
) -> None:
    """Rewrite closed days as few large files in a second place.

    The live folder has a sink log that names its files, so it is not rewritten. Rebalance
    makes even files per day and splits a day that is too large for one.
    """
    days = read_dataset(spark, live, schema).filter(between_days(first, last))
    days.hint("rebalance", *DATE_PARTS).write.partitionBy(*DATE_PARTS).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(compacted)


def read_bronze(
    spark: SparkSession, live: str, compacted: str, schema: StructType, boundary: dt.date
) -> DataFrame:
    """Days before the boundary from the compacted place, the others from the live one."""
    old = read_dataset(spark, compacted, schema).filter(
        between_days(dt.date(1, 1, 1), boundary - dt.timedelta(days=1))
    )
    new = read_dataset(spark, live, schema).filter(between_days(boundary, dt.date(9998, 12, 31)))
    return old.unionByName(new)


def late_rows(query: StreamingQuery) -> int:
    """Rows a stateful query left out because their window had closed."""
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
