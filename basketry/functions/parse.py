"""Keyed JSON records to typed, event-timed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from basketry.config import Settings
from basketry.functions.dates import with_date_parts

AHEAD_MINUTES = Settings().max_ahead_minutes


def _decoded(records: DataFrame, schema: StructType) -> DataFrame:
    # inline makes the parsed fields rows of a generator, below which no filter is pushed;
    # else the text would be parsed once for the filter and once more for the fields.
    text = F.col("value").cast("string")
    fields = records.withColumn("value", text).select(
        F.inline(F.array(F.from_json("value", schema))), "value", "topic", "partition", "offset", "_arrived"
    )
    # try_: a bad timestamp must give null and not end the query (ANSI mode is on).
    return fields.withColumn("event_time", F.try_to_timestamp("timestamp"))


def parse_events(records: DataFrame, schema: StructType, ahead_minutes: int = AHEAD_MINUTES) -> DataFrame:
    """Events with a usable timestamp: contract fields, raw text, position, date parts.

    A time far after the record's arrival is not usable: a single one would move the watermark
    past all events that follow. Records that name no arrival are not checked for that.
    """
    parsed = _decoded(_position_of(records), schema).filter(_usable(ahead_minutes))
    return with_date_parts(parsed.drop("_arrived"), "event_time")


def dead_letters(records: DataFrame, schema: StructType, ahead_minutes: int = AHEAD_MINUTES) -> DataFrame:
    """The records that parse_events leaves out, with the reason."""
    bad = _decoded(_position_of(records), schema).filter(~_usable(ahead_minutes))
    reason = (
        F.when(F.col("value").isNull(), "empty")
        .when(F.col("timestamp").isNull(), "no timestamp")
        .when(F.col("event_time").isNull(), "bad timestamp")
        .otherwise("ahead of its arrival")
    )
    return bad.select("value", "topic", "partition", "offset", reason.alias("reason"))


def _usable(ahead_minutes: int) -> Column:
    latest = F.col("_arrived") + F.make_dt_interval(mins=F.lit(ahead_minutes))
    return F.col("event_time").isNotNull() & F.coalesce(F.col("event_time") <= latest, F.lit(True))


def _position_of(records: DataFrame) -> DataFrame:
    arrived = F.col("timestamp") if "timestamp" in records.columns else F.lit(None)
    return records.select("value", "topic", "partition", "offset", arrived.cast("timestamp").alias("_arrived"))


def of_type(events: DataFrame, event_type: str) -> DataFrame:
    """One kind of event of a topic that carries several."""
    return events.filter(F.col("event_type") == event_type)
