"""Cleaned orders and the gold tables built from them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.scalars import money, normalized, ratio
from basketry.operators.ranking import first_per_key
from basketry.operators.sessions import sessionize


def dedup_orders(orders: DataFrame) -> DataFrame:
    """One row per order: the earliest, whatever the file order."""
    return first_per_key(orders, ["order_id"], [F.col("event_time").asc_nulls_last()])


def first_payments(payments: DataFrame) -> DataFrame:
    """One row per payment: the earliest."""
    return first_per_key(payments, ["payment_id"], [F.col("event_time").asc_nulls_last()])


def clean_orders(orders: DataFrame) -> DataFrame:
    """Deduplicated orders with a positive amount, an order date and a tidy status."""
    return tidy_orders(dedup_orders(orders).withColumn("order_date", F.to_date("event_time")))


def tidy_orders(unique: DataFrame) -> DataFrame:
    """Those of the deduplicated orders with a positive amount, and a tidy status."""
    return unique.filter(F.col("total_amount") > 0).withColumn("order_status_normalized", normalized("order_status"))


def daily_revenue(clean: DataFrame) -> DataFrame:
    total = F.sum(money("total_amount"))
    return clean.groupBy("order_date", "country", "category").agg(
        total.cast("double").alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        ratio(total, F.count("total_amount")).alias("avg_order_value"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def product_performance(clean: DataFrame) -> DataFrame:
    return clean.groupBy("product_id", "product_name", "category").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(money("total_amount")).cast("double").alias("total_revenue"),
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_id").alias("unique_buyers"),
    )


PRODUCT = ("product_id", "product_name", "category")


def first_buyers(clean: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Each buyer of a product with the day of the first order: the product, user_id, first_day.

    `earlier` holds the buyers of the days before these orders; they are no first buyers here.
    """
    pairs = clean.filter("user_id is not null").groupBy(*PRODUCT, "user_id").agg(F.min("order_date").alias("first_day"))
    if earlier is None:
        return pairs
    known = earlier.select(*[F.col(c).alias(f"_{c}") for c in (*PRODUCT, "user_id")])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*PRODUCT, "user_id")])
    return pairs.join(known, same, "left_anti")


def product_days(clean: DataFrame, buyers: DataFrame) -> DataFrame:
    """Sums of a product by day, and how many bought it for the first time; these add up over days."""
    none, nobody = F.lit(0).cast("bigint"), F.lit(0).cast("decimal(18,2)")
    sold = clean.select(
        "order_date", *PRODUCT, F.col("quantity").cast("bigint").alias("units_sold"), money("total_amount").alias("total_revenue"),
        F.col("order_id").isNotNull().cast("bigint").alias("order_count"), none.alias("new_buyers"),
    )
    first = buyers.select(
        F.col("first_day").alias("order_date"), *PRODUCT, F.lit(None).cast("bigint").alias("units_sold"), nobody.alias("total_revenue"),
        none.alias("order_count"), F.lit(1).cast("bigint").alias("new_buyers"),
    )
    return sold.unionByName(first).groupBy("order_date", *PRODUCT).agg(
        *[F.sum(c).alias(c) for c in ("units_sold", "total_revenue", "order_count", "new_buyers")]
    )


def product_totals(days: DataFrame) -> DataFrame:
    """product_performance from the sums of the days."""
    return days.groupBy(*PRODUCT).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("new_buyers").alias("unique_buyers"),
    )


def session_events(activity: DataFrame, orders: DataFrame) -> DataFrame:
    """User activity and orders as one stream of events of a user."""
    visits = activity.select("user_id", "event_time", F.col("activity_type").alias("event_type"))
    bought = orders.select(
        "user_id", "event_time", F.lit("purchase").alias("event_type"), F.col("total_amount").alias("value")
    )
    return bought.unionByName(visits, allowMissingColumns=True)


def session_measures() -> dict[str, Column]:
    bought = F.col("event_type") == "purchase"
    return {"purchases": bought.cast("int"), "value": F.when(bought, money("value"))}


def session_analytics(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Per session of a user: length, events, purchases and their value."""
    return sessionize(events, "user_id", "event_time", gap_minutes * 60, session_measures())
