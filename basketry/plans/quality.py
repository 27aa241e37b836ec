"""Checks between the streaming and the batch side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.scalars import money, percent


def daily_totals(df: DataFrame, date, amount: str, orders: str) -> DataFrame:
    """Revenue and order count per day of a table that holds partial totals."""
    return df.groupBy(date.alias("report_date")).agg(
        F.sum(money(amount)).alias("revenue"), F.sum(orders).alias("orders")
    )


def reconcile(stream: DataFrame, batch: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Compare two daily totals; both hold one row per day."""
    s = stream.withColumnsRenamed({"revenue": "stream_revenue", "orders": "stream_orders"})
    b = batch.withColumnsRenamed({"revenue": "batch_revenue", "orders": "batch_orders"})
    both = s.join(b, "report_date", "full_outer")
    off = F.coalesce("stream_revenue", F.lit(0)) - F.coalesce("batch_revenue", F.lit(0))
    orders_off = F.coalesce("stream_orders", F.lit(0)) - F.coalesce("batch_orders", F.lit(0))
    status = (
        F.when(F.col("stream_orders").isNull(), "missing in stream")
        .when(F.col("batch_orders").isNull(), "missing in batch")
        .when((F.abs(off) > tolerance) | (orders_off != 0), "differs")
        .otherwise("ok")
    )
    return both.select(
        "report_date", "stream_revenue", "batch_revenue", "stream_orders", "batch_orders",
        off.alias("revenue_diff"), orders_off.alias("orders_diff"), status.alias("status"),
    )


def failed_payment_rate(payments: DataFrame, threshold_percent: float = 10.0) -> DataFrame:
    """Share of failed payments per day and whether it passes the threshold."""
    failed = F.count_if(F.col("status") == "failed")
    daily = payments.groupBy(F.to_date("event_time").alias("report_date")).agg(
        F.count(F.lit(1)).alias("payments"), failed.alias("failed")
    )
    rate = percent(F.col("failed"), F.col("payments"))
    return daily.withColumn("failure_rate_pct", rate).withColumn(
        "alert", F.col("failure_rate_pct") > threshold_percent
    )


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Foreign keys of a fact table that the dimension lacks, with the rows they touch."""
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(key), key, "left_anti")
