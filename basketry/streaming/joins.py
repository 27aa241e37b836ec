"""Joins between two streams."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from basketry.config import Settings


def orders_with_payments(
    orders: DataFrame, payments: DataFrame, minutes: int = 10, settings: Settings = Settings(), unpaid: bool = False
) -> DataFrame:
    """Each payment made for an order within some minutes of it.

    Both watermarks and the time bound let Spark drop the state of orders that can no longer
    be paid in time. With `unpaid`, an order without such a payment is a row of its own with
    nulls, which comes when the watermark has passed its time; see `with_open_orders`.
    """
    o = orders.withWatermark("event_time", settings.watermark).select(
        "order_id", "user_id", F.col("event_time").alias("ordered_at"), "total_amount"
    )
    p = payments.withWatermark("event_time", settings.watermark).select(
        F.col("order_id").alias("paid_order"), "payment_id", "status", "amount",
        F.col("event_time").alias("paid_at"),
    )
    # A literal interval: from any other Spark does not tell when the state of an order may go.
    late = F.col("ordered_at") + F.expr(f"INTERVAL {int(minutes)} MINUTES")
    match = (F.col("order_id") == F.col("paid_order")) & F.col("paid_at").between(F.col("ordered_at"), late)
    return o.join(p, match, "left_outer" if unpaid else "inner").drop("paid_order")


def with_open_orders(
    streamed: DataFrame, orders: DataFrame, payments: DataFrame, latest: Column, minutes: int = 10,
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows of a stream of orders_with_payments with unpaid ones, complete up to `latest`.

    Whether an order of the last watermark and minutes before `latest`, the newest event time of
    the slower stream, goes unpaid is still open on the stream. Those orders are joined from the
    tables; all older ones are the stream's.
    """
    closed = latest - F.expr(f"INTERVAL {settings.watermark}") - F.make_dt_interval(mins=F.lit(minutes + 1))
    recent = orders_with_payments(
        orders.filter(F.col("event_time") >= closed), payments.filter(F.col("event_time") >= closed),
        minutes, settings, unpaid=True,
    )
    return streamed.filter(F.col("ordered_at") < closed).unionByName(recent)


def dedup_stream(events: DataFrame, keys: list[str], settings: Settings = Settings()) -> DataFrame:
    """One event per key while the watermark remembers it.

    Events with a null key are told apart by all their columns, so that events without an id
    are not taken for copies of each other.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    unnamed = F.when(~complete, F.to_json(F.struct("*")))
    timed = events.withColumn("_unnamed", unnamed).withWatermark("event_time", settings.watermark)
    return timed.dropDuplicatesWithinWatermark([*keys, "_unnamed"]).drop("_unnamed")
