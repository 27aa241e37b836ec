"""Sessions of a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.config import Settings
from basketry.functions.dates import seconds_of
from basketry.operators.sessions import sessionize


def session_stream(
    events: DataFrame, user: str, time: str, measures: dict[str, Column], settings: Settings = Settings()
) -> DataFrame:
    """Sessions as `sessionize` gives them, each sent once when the watermark has passed its gap.

    The state holds one row per open session, however many events it has. An event exactly a gap
    after another begins a new session.
    """
    known = events.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
    # Spark's window takes in an event at its very end, so it ends the least bit before the gap.
    gap = f"{seconds_of(settings.session_gap) - 1} seconds 999999 microseconds"
    given = known.select(
        user, F.col(time).alias("_at"), *[expr.alias(name) for name, expr in measures.items()]
    )
    sessions = given.withWatermark("_at", settings.watermark).groupBy(
        user, F.session_window("_at", gap).alias("_w")
    ).agg(
        F.min("_at").alias("session_start"), F.max("_at").alias("session_end"), F.count(F.lit(1)).alias("events"),
        *[F.sum(name).alias(name) for name in measures],
    )
    return sessions.drop("_w")


def with_open_sessions(
    closed: DataFrame, events: DataFrame, user: str, time: str, measures: dict[str, Column],
    settings: Settings = Settings(),
) -> DataFrame:
    """Closed sessions of a stream, and those that the watermark still holds open, from the table.

    Sessions of a user close in order of time, so all events after the last closed one of a user
    belong to open sessions.
    """
    last = closed.groupBy(F.col(user).alias("_closed")).agg(F.max("session_end").alias("_last"))
    rest = events.join(last, F.col(user) == F.col("_closed"), "left")
    rest = rest.filter(F.col("_last").isNull() | (F.col(time) > F.col("_last"))).drop("_closed", "_last")
    open_ones = sessionize(rest, user, time, seconds_of(settings.session_gap), measures)
    return closed.unionByName(open_ones.select(*closed.columns))
