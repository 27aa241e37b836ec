"""Counts of earlier events of the same key within a time span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def trailing_counts(
    events: DataFrame, key: str, time: str, counted: Column, seconds: int
) -> DataFrame:
    """Add to each event the number and the last time of counted events in [time - span, time].

    Time is cut into slots one span long, so all that matters to an event lies in its own slot
    or the one before: a busy key is split by time. A counted event adds one from its time on
    and, in the next slot, takes it away again just after its span has passed; the count is a
    running sum, so a slot costs one sorted pass however many events it has. An event without
    key or time counts for nobody and has the count 0.
    """
    span = seconds * 1_000_000
    micros = F.unix_micros(time)
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    own = F.floor(micros / F.lit(span))

    def mark(slot: Column, at: Column, change: Column, last: Column, itself: bool) -> Column:
        return F.struct(
            slot.alias("slot"), at.alias("at"), change.alias("change"), last.alias("last"), F.lit(itself).alias("itself")
        )

    one, none = F.lit(1), F.lit(None).cast("long")
    hit = F.coalesce(counted, F.lit(False))
    itself = mark(own, micros * 2, hit.cast("int"), F.when(hit, micros), True)
    # Odd places lie between two instants: an event at the very end of the span still counts.
    after = F.array(
        itself, mark(own + 1, micros * 2, one, micros, False),
        mark(own + 1, (micros + span) * 2 + 1, -one, none, False),
    )
    marked = events.filter(known).withColumn("_m", F.explode(F.when(hit, after).otherwise(F.array(itself))))
    so_far = (
        Window.partitionBy(key, F.col("_m.slot")).orderBy(F.col("_m.at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = marked.withColumn("trailing_count", F.sum("_m.change").over(so_far).cast("long"))
    seen = seen.withColumn("_last", F.max("_m.last").over(so_far)).filter("_m.itself")
    inside = F.when(F.col("trailing_count") > 0, F.timestamp_micros("_last"))
    out = seen.withColumn("last_counted_at", inside).drop("_m", "_last")
    unknown = events.filter(~known).withColumn("trailing_count", F.lit(0).cast("long"))
    return out.union(unknown.withColumn("last_counted_at", F.lit(None).cast("timestamp")))
