"""Per-minute metrics over parsed events; each function serves streams and tables alike.

The watermark of a stream is set by who starts it (streaming.app.metric_frame).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from basketry.config import Settings
from basketry.functions.scalars import money
from basketry.operators.ranking import top_k_per_group

DEFAULTS = Settings()


def _by_window(events: DataFrame, settings: Settings, *keys: str) -> GroupedData:
    """Tumbling windows [start, end) on event_time."""
    return events.groupBy(F.window("event_time", settings.window).alias("w"), *keys)


def _flat(df: DataFrame, *columns: str | Column, end: bool = True) -> DataFrame:
    bounds = [F.col("w.start").alias("window_start")]
    if end:
        bounds.append(F.col("w.end").alias("window_end"))
    return df.select(*bounds, *columns)


def revenue_per_minute(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(orders, settings).agg(
        F.sum(money("total_amount")).alias("total_revenue"), F.count("order_id").alias("order_count")
    )
    return _flat(agg, "total_revenue", "order_count")


def geographic_metrics(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(orders, settings, "country").agg(
        F.count("order_id").alias("order_count"), F.sum(money("total_amount")).alias("revenue")
    )
    return _flat(agg, "country", "order_count", "revenue", end=False)


def product_metrics(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Units and revenue per product and minute, not yet ranked.

    A micro-batch holds changed products only, so ranking is left to the reader of the
    whole table (top_products).
    """
    agg = _by_window(orders, settings, "product_id").agg(
        F.min("product_name").alias("product_name"),
        F.sum("quantity").alias("units_sold"),
        F.sum(money("total_amount")).alias("revenue"),
    )
    return _flat(agg, "product_id", "product_name", "units_sold", "revenue", end=False)


def top_products(products: DataFrame, k: int = 5) -> DataFrame:
    """The k products of each window with the highest revenue; ties go by product id."""
    order = [F.col("revenue").desc_nulls_last(), F.col("product_id").asc()]
    return top_k_per_group(products, ["window_start"], order, k)


def failed_payments(payments: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(payments.filter(F.col("status") == "failed"), settings).agg(
        F.count("payment_id").alias("failure_count"), F.sum(money("amount")).alias("failure_amount")
    )
    return _flat(agg, "failure_count", "failure_amount")


# Fixed value: 2 ** 14 registers give a standard error of about 0.8 percent. Up to some 1,500
# values a sketch holds the hashes themselves, and its count is exact but for equal hashes.
SKETCH_SIZE = 14


def _approx_distinct(column: str) -> Column:
    """About how many distinct values there are, within a few percent at any number of them.

    The registers of approx_count_distinct are so few that a window of a dozen values in tens of
    thousands is off by more than 15 percent. The mark before the value makes an empty text count.
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.concat(F.lit("="), F.col(column)), SKETCH_SIZE))


def active_users_approx(activity: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(activity, settings).agg(_approx_distinct("user_id").alias("active_user_count"))
    return _flat(agg, "active_user_count")


def user_sketches(activity: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A sketch of the users of each window; sketches of windows add up to those of longer spans."""
    agg = _by_window(activity, settings).agg(F.hll_sketch_agg("user_id", SKETCH_SIZE).alias("users"))
    return _flat(agg, "users")


def active_users_over(sketches: DataFrame, span: str) -> DataFrame:
    """Distinct users per longer span, such as an hour or a day, from stored sketches of windows."""
    merged = sketches.groupBy(F.window("window_start", span).alias("w")).agg(
        F.hll_union_agg("users", True).alias("users")  # sketches stored before may be smaller
    )
    return _flat(merged, F.hll_sketch_estimate("users").alias("active_user_count"))


def active_users_exact(activity: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Exact count by two aggregations, which a stream accepts in append mode.

    The first leaves one row per window and user, so a busy user weighs as little as any.
    """
    users = _by_window(activity.filter(F.col("user_id").isNotNull()), settings, "user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    agg = users.groupBy(F.window(F.window_time("w"), settings.window).alias("w")).agg(
        F.count(F.lit(1)).alias("active_user_count")
    )
    return _flat(agg, "active_user_count")


def with_open_windows(
    closed: DataFrame, activity: DataFrame, latest: Column, settings: Settings = DEFAULTS
) -> DataFrame:
    """Exact user counts of closed windows, and of those that the watermark still holds open.

    The open ones are counted from the events of the last watermark and window before `latest`,
    the newest event time.
    """
    start = latest - F.expr(f"INTERVAL {settings.watermark}") - F.expr(f"INTERVAL {settings.window}")
    recent = active_users_exact(activity.filter(F.col("event_time") >= start), settings)
    return closed.unionByName(recent.join(closed, "window_start", "left_anti"))


def click_windows(clicks: DataFrame, exact: bool = False, settings: Settings = DEFAULTS) -> DataFrame:
    """Page views, distinct sessions and the page seen first; exact counts are for tables."""
    distinct = F.count_distinct if exact else _approx_distinct
    first = F.min_by("page_url", F.struct("event_time", "event_id"))
    agg = _by_window(clicks, settings).agg(
        F.count("event_id").alias("page_views"),
        distinct("session_id").alias("unique_sessions"),
        first.alias("first_page"),
    )
    return _flat(agg, "page_views", "unique_sessions", "first_page")


def page_windows(clicks: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(clicks, settings, "page_url").agg(F.count("event_id").alias("views"))
    return _flat(agg, "page_url", "views", end=False)


def clickstream_metrics(windows: DataFrame, pages: DataFrame) -> DataFrame:
    """Click windows with their most viewed page; ties go to the first page by name."""
    order = [F.col("views").desc(), F.col("page_url").asc()]
    seen = pages.filter(F.col("page_url").isNotNull())
    top = top_k_per_group(seen, ["window_start"], order, 1, "_rn")
    return windows.join(
        top.select("window_start", F.col("page_url").alias("top_page")), "window_start", "left"
    )


def inventory_changes(updates: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Net change and last known stock per product, warehouse and minute."""
    agg = _by_window(updates, settings, "product_id", "warehouse_id").agg(
        F.count("update_id").alias("update_count"),
        F.sum("quantity_delta").alias("net_delta"),
        F.max_by("new_stock", F.struct("event_time", "update_id")).alias("last_stock"),
    )
    return _flat(agg, "product_id", "warehouse_id", "update_count", "net_delta", "last_stock", end=False)


def returns_by_reason(returns: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    agg = _by_window(returns, settings, "reason").agg(
        F.count("return_id").alias("return_count"), F.sum(money("refund_amount")).alias("refunds")
    )
    return _flat(agg, "reason", "return_count", "refunds", end=False)


def net_revenue(topic: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Orders minus refunds per minute, from one pass over the mixed orders topic."""
    placed = F.when(F.col("event_type") == "order_placed", money("total_amount"))
    refunded = F.when(F.col("event_type") == "order_returned", money("refund_amount"))
    zero = F.lit(0).cast("decimal(18,2)")
    agg = _by_window(topic, settings).agg(
        F.coalesce(F.sum(placed), zero).alias("gross_revenue"),
        F.coalesce(F.sum(refunded), zero).alias("refunds"),
    )
    return _flat(
        agg, "gross_revenue", "refunds", (F.col("gross_revenue") - F.col("refunds")).alias("net_revenue")
    )
