"""Reads behind a live dashboard. `as_of` is given by the caller, never taken from the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import as_column, since_minutes
from basketry.operators.ranking import top_n


def dashboard_snapshot(
    revenue: DataFrame, users: DataFrame, failed: DataFrame, top: DataFrame, geo: DataFrame
) -> DataFrame:
    """One row built in one read, so all cards belong to the same committed state.

    Each metric table is cut to its latest value by an aggregate; the values are put
    together as scalar subqueries.
    """
    latest = "window_start"
    rank_order = F.struct(F.col(latest), -F.col("rank_position"))
    # Equal revenue: the first country by name wins, as everywhere else.
    newest = geo.agg(F.max(latest)).scalar()
    geo_now = geo.filter(F.col(latest) == newest).orderBy(F.col("revenue").desc_nulls_last(), "country").limit(1)
    row = revenue.agg(
        F.max_by("total_revenue", latest).alias("total_revenue"),
        F.max_by("order_count", latest).alias("orders_per_minute"),
        F.max(latest).alias("snapshot_time"),
    )
    return row.select(
        F.lit(1).alias("id"),
        F.coalesce("total_revenue", F.lit(0)).alias("total_revenue"),
        F.coalesce("orders_per_minute", F.lit(0)).alias("orders_per_minute"),
        F.coalesce(users.agg(F.max_by("active_user_count", latest)).scalar(), F.lit(0)).alias("active_users"),
        F.coalesce(failed.agg(F.max_by("failure_count", latest)).scalar(), F.lit(0)).alias("failed_payments"),
        top.agg(F.max_by("product_name", rank_order)).scalar().alias("top_product"),
        geo_now.select("country").scalar().alias("top_country"),
        "snapshot_time",
    )


def kpi_cards(snapshot: DataFrame) -> DataFrame:
    """The snapshot as shown, with a placeholder for missing names."""
    return snapshot.select(
        F.col("total_revenue").cast("double").alias("total_revenue"),
        F.col("orders_per_minute").cast("bigint").alias("orders_per_minute"),
        F.col("active_users").cast("bigint").alias("active_users"),
        F.col("failed_payments").cast("bigint").alias("failed_payments"),
        F.coalesce("top_product", F.lit("N/A")).alias("top_product"),
        F.coalesce("top_country", F.lit("N/A")).alias("top_country"),
        "snapshot_time",
    )


def recent(metric: DataFrame, as_of, minutes: int) -> DataFrame:
    return metric.filter(since_minutes("window_start", as_of, minutes))


def revenue_series(revenue: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    rows = recent(revenue, as_of, minutes)
    return rows.select("window_start", "total_revenue", "order_count").orderBy("window_start")


def active_user_series(users: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    return recent(users, as_of, minutes).select("window_start", "active_user_count").orderBy("window_start")


def latest_top_products(top: DataFrame, as_of, minutes: int = 30, rows: int = 10) -> DataFrame:
    picked = top_n(recent(top, as_of, minutes), rows, F.col("window_start").desc(), F.col("rank_position"))
    return picked.select("product_name", "units_sold", "revenue", "rank_position")


def top_product_bars(latest: DataFrame, bars: int = 8) -> DataFrame:
    """Second roll-up of the ranked rows by name, for the chart."""
    by_name = latest.groupBy("product_name").agg(
        F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold")
    )
    return top_n(by_name, bars, F.col("revenue").desc(), F.col("product_name"))


def geo_totals(geo: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    return (
        recent(geo, as_of, minutes)
        .groupBy("country")
        .agg(F.sum("order_count").alias("orders"), F.sum("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "country")
    )


def click_series(clicks: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    rows = recent(clicks, as_of, minutes)
    return rows.select("window_start", "page_views", "unique_sessions", "top_page").orderBy("window_start")


def last_click_windows(series: DataFrame, rows: int = 6) -> DataFrame:
    return top_n(series, rows, F.col("window_start").desc())


def has_live_data(revenue: DataFrame) -> DataFrame:
    """One boolean row; reads no further than the first row found."""
    return revenue.select(F.lit(1).alias("x")).limit(1).agg((F.count("x") > 0).alias("has_live_data"))


def load_metrics(tables: dict[str, DataFrame], as_of, minutes: int) -> dict[str, DataFrame]:
    """All panels of the dashboard; rankings, map and clicks look back an hour at most."""
    as_of = as_column(as_of)
    short = min(minutes, 60)
    snapshot = dashboard_snapshot(
        tables["revenue"], tables["users"], tables["failed"], tables["top_products"], tables["geo"]
    )
    return {
        "kpis": kpi_cards(snapshot),
        "revenue_ts": revenue_series(tables["revenue"], as_of, minutes),
        "users_ts": active_user_series(tables["users"], as_of, minutes),
        "top_products": latest_top_products(tables["top_products"], as_of, short),
        "geo": geo_totals(tables["geo"], as_of, short),
        "clicks": click_series(tables["clicks"], as_of, short),
        "live": has_live_data(tables["revenue"]),
    }
