"""Sessions: runs of events of one user with no pause of `gap` or longer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def sessionize(
    events: DataFrame, user: str, time: str, gap_seconds: int, measures: dict[str, Column]
) -> DataFrame:
    """One row per session: user, session_start, session_end, events and summed measures.

    Events of one user in the same gap-long slot are less than a gap apart, so they belong
    together and are added up before the shuffle. What is left per user is one row per slot,
    however many events the user has. Two events exactly a gap apart are two sessions. Events
    without user or time belong to no session: visitors who are not known are not one user.
    """
    numbered = _numbered(_slots(events, user, time, gap_seconds, measures, []), user, gap_seconds)
    return (
        numbered.groupBy(user, "_session")
        .agg(
            F.timestamp_micros(F.min("_lo")).alias("session_start"),
            F.timestamp_micros(F.max("_hi")).alias("session_end"),
            F.sum("events").alias("events"),
            *[F.sum(name).alias(name) for name in measures],
        )
        .drop("_session")
    )


def session_states(
    events: DataFrame, carried: DataFrame | None, user: str, time: str, gap_seconds: int, measures: dict[str, Column]
) -> DataFrame:
    """Sessions as they stand at the end of each of their days, with the day of the last event.

    `carried` holds sessions, in the same columns, that may go on in these events: those of the day
    before whose last event is less than a gap before midnight (`carry`). Columns: user,
    session_start, session_end, events, the measures, day, and whether the session ends there
    (`ended`), which is the state that `sessionize` gives. The gap must be shorter than a day, so
    that a session has a state on each day that it reaches.
    """
    if gap_seconds >= 86400:
        raise ValueError("a session must not go on over a whole day without events")
    columns = [user, "_lo", "_hi", "events", *measures]
    pieces = _slots(events, user, time, gap_seconds, measures, [F.to_date(time).alias("_day")]).select(*columns)
    if carried is not None:
        lo, hi = (F.unix_micros(c).alias(n) for c, n in (("session_start", "_lo"), ("session_end", "_hi")))
        pieces = pieces.unionByName(carried.select(user, lo, hi, "events", *measures))
    numbered = _numbered(pieces, user, gap_seconds).withColumn("day", F.to_date(F.timestamp_micros("_hi")))
    inside = Window.partitionBy(user, "_session").orderBy("_lo")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    following = F.lead("day").over(inside)
    totals = {name: F.sum(name).over(so_far) for name in ("events", *measures)}
    states = numbered.withColumns({**totals, "_start": F.min("_lo").over(so_far), "_following": following})
    return states.filter(F.col("_following").isNull() | (F.col("_following") != F.col("day"))).select(
        user, F.timestamp_micros("_start").alias("session_start"), F.timestamp_micros("_hi").alias("session_end"),
        "events", *measures, "day", F.col("_following").isNull().alias("ended"),
    )


def carry(states: DataFrame, gap_seconds: int) -> DataFrame:
    """The states that an event of the next day may go on from."""
    midnight = F.unix_micros(F.date_add("day", 1).cast("timestamp"))
    return states.filter(midnight - F.unix_micros("session_end") < gap_seconds * 1_000_000)


def _slots(
    events: DataFrame, user: str, time: str, gap_seconds: int, measures: dict[str, Column], also: list[Column]
) -> DataFrame:
    """Events added up by user and gap-long slot, with their first and last instant."""
    events = events.filter(F.col(user).isNotNull() & F.col(time).isNotNull())
    micros = F.unix_micros(time)
    sums = [F.sum(expr).alias(name) for name, expr in measures.items()]
    slot = F.floor(micros / F.lit(gap_seconds * 1_000_000)).alias("_slot")
    return events.groupBy(user, slot, *also).agg(
        F.min(micros).alias("_lo"), F.max(micros).alias("_hi"), F.count(F.lit(1)).alias("events"), *sums
    )


def _numbered(pieces: DataFrame, user: str, gap_seconds: int) -> DataFrame:
    """Pieces of sessions, which do not overlap, with the number of their session."""
    by_user = Window.partitionBy(user).orderBy("_lo")
    opens = F.col("_lo") - F.lag("_hi").over(by_user) >= gap_seconds * 1_000_000
    marked = pieces.withColumn("_opens", F.coalesce(opens, F.lit(True)).cast("int"))
    return marked.withColumn("_session", F.sum("_opens").over(by_user))
