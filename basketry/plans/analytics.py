"""Analytical queries over the star schema.

Filters are put on date_key, the partition column of the facts, so that whole days are
skipped; the date dimension joins after the aggregate, to one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.dates import as_column, date_key
from basketry.functions.scalars import money, percent, ratio
from basketry.operators.funnel import funnel_steps
from basketry.operators.intervals import trailing_counts
from basketry.operators.ranking import top_n
from basketry.operators.skew import fits_broadcast, lookup_join, skew_join
from basketry.plans.gold import dedup_orders, first_payments


def daily_trend(fact: DataFrame, dim_date: DataFrame, as_of, days: int = 30) -> DataFrame:
    first = date_key(F.date_sub(F.to_date(as_column(as_of)), days))
    daily = fact.filter(F.col("date_key") >= first).groupBy("date_key").agg(
        F.sum("total_amount").alias("daily_revenue"),
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("user_key").alias("unique_customers"),
    )
    named = daily.join(dim_date.select("date_key", "full_date", "day_name"), "date_key")
    return named.select(
        "full_date", "day_name", "daily_revenue", "order_count", "unique_customers"
    ).orderBy(F.col("full_date").desc())


def top_products_of_month(
    fact: DataFrame, dim_products: DataFrame, as_of, n: int = 10, stored: DataFrame | None = None
) -> DataFrame:
    month = F.trunc(F.to_date(as_column(as_of)), "month")
    in_month = F.col("date_key").between(date_key(month), date_key(F.last_day(month)))
    current = dim_products.filter("is_current").select("product_key", "product_name", "category")
    sold = lookup_join(fact.filter(in_month), current, ["product_key"], "inner", stored=stored)
    by_product = sold.groupBy("product_name", "category").agg(
        F.sum("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("units_sold"),
        F.count_distinct("order_id").alias("order_count"),
    )
    return top_n(by_product, n, F.col("total_revenue").desc(), F.col("product_name"), F.col("category"))


def revenue_by_country(fact: DataFrame, dim_users: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Country of the order, or that of the buyer where the order has none.

    Facts are summed up per country, or per buyer where they have none, before any buyer is looked
    up; so the join sees one row per buyer, however many orders a buyer has.
    """
    buyers = dim_users.select("user_key", F.col("country").alias("_home"))
    asked = F.when(F.col("shipping_country").isNull(), F.col("user_key")).alias("user_key")
    sums = fact.groupBy("shipping_country", asked).agg(
        F.sum("total_amount").alias("_total"),
        F.count(F.lit(1)).alias("_rows"),
        F.count("total_amount").alias("_amounts"),
    )
    side = F.broadcast(buyers) if fits_broadcast(stored if stored is not None else dim_users) else buyers
    total = F.sum("_total")
    return (
        sums.join(side, "user_key", "left")
        .groupBy(F.coalesce("shipping_country", "_home").alias("country"))
        .agg(
            total.alias("total_revenue"),
            F.sum("_rows").alias("order_count"),
            ratio(total, F.sum("_amounts")).alias("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc())
    )


def payment_failures(payments: DataFrame, as_of, days: int = 7) -> DataFrame:
    day = F.date_sub(F.to_date(as_column(as_of)), days)
    recent = payments.filter(
        (F.col("date_key") >= date_key(day)) & (F.col("payment_timestamp") >= day.cast("timestamp"))
    )
    failed = F.col("payment_status") == "failed"
    return (
        recent.groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("total_payments"),
            F.count_if(failed).alias("failed_payments"),
            F.coalesce(F.sum(F.when(failed, F.col("amount"))), F.lit(0)).alias("failed_amount"),
        )
        .withColumn("failure_rate_pct", percent(F.col("failed_payments"), F.col("total_payments")))
        .orderBy(F.col("failure_rate_pct").desc(), "payment_method")
    )


def monthly_buyers(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Distinct buyers per month, with revenue and mean order value."""
    # A row per date_key is one calendar day, so its month can join before the aggregate
    # without changing the number of facts.
    months = dim_date.select("date_key", F.trunc("full_date", "month").alias("order_month"))
    total = F.sum("total_amount")
    return (
        fact.join(F.broadcast(months), "date_key")  # one row per calendar day
        .groupBy("order_month")
        .agg(
            F.count_distinct("user_key").alias("active_buyers"),
            total.alias("monthly_revenue"),
            ratio(total, F.count("total_amount")).alias("avg_order_value"),
        )
        .orderBy(F.col("order_month").desc())
    )


def year_over_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = fact.groupBy("date_key").agg(F.sum("total_amount").alias("revenue"))
    monthly = (
        daily.join(dim_date.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month")
        .agg(F.sum("revenue").alias("revenue"))
    )
    previous = monthly.select(
        (F.col("year") + 1).cast("smallint").alias("year"), "month", F.col("revenue").alias("previous_year_revenue")
    )
    growth = percent(
        F.col("current_revenue") - F.col("previous_year_revenue"),
        F.nullif("previous_year_revenue", F.lit(0)),
    )
    return (
        monthly.withColumnRenamed("revenue", "current_revenue")
        .join(previous, ["year", "month"], "left")
        .withColumn("yoy_growth_pct", growth)
        .orderBy(F.col("year").desc(), F.col("month").desc())
    )


def cohort_retention(activity: DataFrame, user: str, date: str) -> DataFrame:
    """Buyers by month of first purchase and months since then, with the share still active."""
    known = activity.filter(F.col(user).isNotNull())
    months = known.select(user, F.trunc(date, "month").alias("_month")).distinct()
    # At most one row per user and month is left, so a busy user is no heavier than others.
    first = F.min("_month").over(Window.partitionBy(user))
    offset = F.months_between("_month", "cohort_month").cast("int")
    counts = (
        months.withColumn("cohort_month", first)
        .groupBy("cohort_month", offset.alias("months_since"))
        .agg(F.count(F.lit(1)).alias("buyers"))
    )
    sizes = Window.partitionBy("cohort_month").orderBy("months_since")
    return counts.withColumn(
        "retention_pct", percent(F.col("buyers"), F.first("buyers").over(sizes))
    )


def order_payments(orders: DataFrame, payments: DataFrame, minutes: int = 10) -> DataFrame:
    """Each order with the payments made for it within some minutes; one row per order.

    Orders and payments that were delivered again count once, at their first time; an order
    without id is left out, as no payment can name it. Payments are the skewed side (retries), so they are salted and counted per order before
    the orders are brought in again.
    """
    orders = dedup_orders(orders.filter("order_id is not null"))
    raw, payments = payments, _each_payment_once(payments)
    asked = orders.select("order_id", F.col("event_time").alias("ordered_at"))
    late = F.col("ordered_at") + F.make_dt_interval(mins=F.lit(minutes))
    in_time = F.col("event_time").between(F.col("ordered_at"), late)
    paid = skew_join(
        payments.select("order_id", "event_time", "status", money("amount").alias("amount")),
        asked, ["order_id"], "inner", in_time, counted=raw,
    )
    ok = F.col("status") == "success"
    per_order = paid.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == "failed").alias("failures"),
        F.coalesce(F.sum(F.when(ok, F.col("amount"))), F.lit(0)).alias("paid_amount"),
        F.min("event_time").alias("first_payment"),
    )
    return orders.select("order_id", "user_id", F.col("event_time").alias("ordered_at"), "total_amount").join(
        per_order, "order_id", "left"
    ).fillna(0, ["attempts", "failures", "paid_amount"])


def _each_payment_once(payments: DataFrame) -> DataFrame:
    """The earliest copy of each payment, and all payments without an id, which are no copies."""
    if "payment_id" not in payments.columns:
        return payments
    known = first_payments(payments.filter("payment_id is not null"))
    return known.unionByName(payments.filter("payment_id is null"))


def clicks_before_purchase(events: DataFrame, minutes: int = 10) -> DataFrame:
    """For each purchase the clicks of the same user in the minutes before it.

    Counts come from sorted running totals and not from purchase-click pairs, so a user with
    very many clicks costs no more than one pass over them.
    """
    clicks = F.col("event_type") == "click"
    seen = trailing_counts(
        events.filter(clicks | (F.col("event_type") == "purchase")), "user_id", "event_time", clicks, minutes * 60
    )
    return seen.filter(F.col("event_type") == "purchase")


def shopping_events(clicks: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """What users do on their way to a payment, as one stream of events. Clicks may name their kind
    in event_type; all others count as views."""
    kind = F.col("event_type") if "event_type" in clicks.columns else F.lit(None)
    step = F.when(kind == "click", "click").otherwise("view")
    seen = clicks.select("user_id", "event_time", step.alias("step"))
    bought = orders.select("user_id", "event_time", F.lit("order").alias("step"))
    paid = payments.filter(F.col("status") == "success").select("user_id", "event_time", F.lit("payment").alias("step"))
    return seen.unionByName(bought).unionByName(paid)


def shopping_funnel(
    clicks: DataFrame, orders: DataFrame, payments: DataFrame, minutes: int = 30,
    steps: tuple[str, ...] = ("view", "click", "order", "payment"),
) -> DataFrame:
    """How many users view, then click, then order, then pay within some minutes of the view."""
    events = shopping_events(clicks, orders, payments)
    return funnel_steps(events, "user_id", "event_time", {s: F.col("step") == s for s in steps}, minutes * 60)
