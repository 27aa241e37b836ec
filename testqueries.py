"""Every query of the engine on the test tables; see testviews for the roles they play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StructType, TimestampType

import testviews as tv
from basketry import schemas
from basketry.config import Settings
from basketry.functions import parse, scalars
from basketry.functions.dates import date_key
from basketry.operators.keys import assign_keys
from basketry.operators.versions import as_of_lookup, scd2
from basketry.plans import analytics, cdc, gold, kpi, quality, serving, warehouse
from basketry.session import scratch_path, streaming_session
from basketry.streaming import app, upsert_log
from basketry.streaming.bronze import append_stream
from basketry.streaming.joins import orders_with_payments, with_open_orders
from basketry.streaming.sessions import session_stream, with_open_sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query; decimals leave as double and zoned times as wall-clock times."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(fn(spark, sf))

    QUERIES[fn.__name__] = run
    return fn


def _plain(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        columns.append(c)
    return df.select(*columns)


# Ingest

PARSED = (
    "event_type", "order_id", "user_id", "product_id", "quantity", "total_amount",
    "refund_amount", "reason", "country", "event_time", "year", "month", "day",
)


@query
def parse_events(spark, sf):
    return tv.parsed_orders(tv.events(spark, sf)).select(*PARSED)


@query
def bronze_events(spark, sf):
    """The orders topic drained through the bronze sink and read back."""
    session = streaming_session(spark, Settings())
    root = scratch_path(spark, "bronze")
    parsed = parse.parse_events(tv.order_records(tv.events_stream(session, sf)), schemas.ORDERS_TOPIC)
    append_stream(parsed, f"{root}/orders", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.bronze("orders")).parquet(f"{root}/orders").select(*PARSED)


@query
def bronze_replay_revenue(spark, sf):
    """Bronze replayed as a table through the metric that also runs on the stream."""
    session = streaming_session(spark, Settings())
    root = scratch_path(spark, "replay")
    parsed = parse.parse_events(tv.order_records(tv.events_stream(session, sf)), schemas.ORDERS_TOPIC)
    append_stream(parsed, f"{root}/orders", f"{root}/checkpoint").awaitTermination()
    bronze = spark.read.schema(schemas.bronze("orders")).parquet(f"{root}/orders")
    return kpi.revenue_per_minute(parse.of_type(bronze, "order_placed"))


# Per-minute metrics


@query
def kpi_revenue_per_minute(spark, sf):
    return kpi.revenue_per_minute(tv.minute_orders(tv.events(spark, sf)))


@query
def kpi_geographic(spark, sf):
    return kpi.geographic_metrics(tv.minute_orders(tv.events(spark, sf)))


def _top_products(ev):
    return kpi.top_products(kpi.product_metrics(tv.minute_orders(ev)))


@query
def kpi_top_products(spark, sf):
    return _top_products(tv.events(spark, sf))


@query
def kpi_failed_payments(spark, sf):
    return kpi.failed_payments(tv.payments(tv.events(spark, sf)))


@query
def kpi_active_users_exact(spark, sf):
    return kpi.active_users_exact(tv.activity(tv.events(spark, sf)))


@query
def kpi_active_users_approx(spark, sf):
    return kpi.active_users_approx(tv.activity(tv.events(spark, sf)))


@query
def kpi_active_users_approx_check(spark, sf):
    """Per window the exact count, and whether the estimate is within 15 % of it (or of one)."""
    activity = tv.activity(tv.events(spark, sf))
    return _near(kpi.active_users_approx(activity), kpi.active_users_exact(activity), 0.15)


def _clickstream(ev):
    clicks = tv.clicks(ev)
    return kpi.clickstream_metrics(kpi.click_windows(clicks, exact=True), kpi.page_windows(clicks))


@query
def kpi_clickstream(spark, sf):
    return _clickstream(tv.events(spark, sf))


@query
def kpi_inventory(spark, sf):
    return kpi.inventory_changes(tv.stock_updates(tv.events(spark, sf)))


@query
def kpi_returns(spark, sf):
    return kpi.returns_by_reason(tv.minute_returns(tv.events(spark, sf)))


@query
def kpi_net_revenue(spark, sf):
    return kpi.net_revenue(tv.orders_topic(tv.events(spark, sf)))


# The same metrics drained as streams through their keyed tables


def _drain(spark: SparkSession, sf: str, metric: str, events_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    settings = Settings()
    session = streaming_session(spark, settings)
    root = scratch_path(spark, metric)
    events = events_of(tv.events_stream(session, sf))
    schema: StructType = app.metric_frame(metric, events, settings).schema
    app.start_metric(metric, events, settings, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return upsert_log.read_table(spark, f"{root}/table", schema, app.METRICS[metric].keys)


@query
def kpi_revenue_per_minute_stream(spark, sf):
    def parsed(ev):
        return parse.parse_events(tv.order_records(ev), schemas.ORDERS_TOPIC)

    return _drain(spark, sf, "revenue_per_minute", parsed)


@query
def kpi_geographic_stream(spark, sf):
    return _drain(spark, sf, "geographic_metrics", tv.orders_topic)


@query
def kpi_top_products_stream(spark, sf):
    return kpi.top_products(_drain(spark, sf, "product_metrics", tv.orders_topic))


@query
def kpi_failed_payments_stream(spark, sf):
    return _drain(spark, sf, "failed_payments", tv.payments)


@query
def kpi_active_users_exact_stream(spark, sf):
    """Windows that the watermark has passed from the stream, the last ones counted from the table."""
    closed = _drain(spark, sf, "active_users_exact", tv.activity)
    ev = tv.events(spark, sf)
    return kpi.with_open_windows(closed, tv.activity(ev), tv.latest(ev, "event_time"))


@query
def kpi_active_users_approx_stream(spark, sf):
    return _drain(spark, sf, "active_users", tv.activity)


def _near(estimate: DataFrame, exact: DataFrame, share: float) -> DataFrame:
    """The exact counts, and whether the estimate is within a share of them (or one)."""
    both = exact.join(estimate.withColumnRenamed("active_user_count", "estimate"), ["window_start", "window_end"])
    off = F.abs(F.col("estimate") - F.col("active_user_count"))
    return both.withColumn("within", off <= F.greatest(F.lit(1.0), share * F.col("active_user_count"))).drop("estimate")


@query
def kpi_active_users_approx_stream_check(spark, sf):
    """Per window the exact count, and whether the estimate of the stream is within 15 % of it."""
    estimate = _drain(spark, sf, "active_users", tv.activity)
    return _near(estimate, kpi.active_users_exact(tv.activity(tv.events(spark, sf))), 0.15)


@query
def kpi_active_users_hourly(spark, sf):
    """Sketches of the minutes, stored by the stream, rolled up to hours: the exact count, and whether
    the estimate is within three standard errors of it."""
    sketches = _drain(spark, sf, "user_sketches", tv.activity)
    exact = kpi.active_users_exact(tv.activity(tv.events(spark, sf)), Settings(window="1 hour"))
    return _near(kpi.active_users_over(sketches, "1 hour"), exact, 0.05)


@query
def kpi_active_users_daily(spark, sf):
    """The same by day, from sketches of the table."""
    activity = tv.activity(tv.events(spark, sf))
    exact = kpi.active_users_exact(activity, Settings(window="1 day"))
    return _near(kpi.active_users_over(kpi.user_sketches(activity), "1 day"), exact, 0.05)


@query
def kpi_clickstream_stream(spark, sf):
    """The estimate of sessions is given as the exact count and whether it is within 15 % of it."""
    windows = _drain(spark, sf, "click_windows", tv.clicks).withColumnRenamed("unique_sessions", "estimate")
    pages = _drain(spark, sf, "page_windows", tv.clicks)
    exact = kpi.click_windows(tv.clicks(tv.events(spark, sf)), exact=True).select("window_start", "unique_sessions")
    off = F.abs(F.col("estimate") - F.col("unique_sessions"))
    close = off <= F.greatest(F.lit(1.0), 0.15 * F.col("unique_sessions"))
    windows = windows.join(exact, "window_start").withColumn("within", close).drop("estimate")
    return kpi.clickstream_metrics(windows, pages)


@query
def kpi_inventory_stream(spark, sf):
    return _drain(spark, sf, "inventory_changes", tv.stock_updates)


@query
def kpi_returns_stream(spark, sf):
    return _drain(spark, sf, "returns_by_reason", tv.orders_topic)


@query
def kpi_net_revenue_stream(spark, sf):
    return _drain(spark, sf, "net_revenue", tv.orders_topic)


def _appended(spark: SparkSession, name: str, stream: DataFrame) -> DataFrame:
    """What a stream in append mode has sent when all its input is read."""
    root = scratch_path(spark, name)
    writer = stream.writeStream.format("parquet").option("path", f"{root}/rows")
    writer = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def _paid_stream(spark: SparkSession, sf: str, name: str, payments_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    session = streaming_session(spark, Settings())
    joined = orders_with_payments(
        tv.minute_orders(tv.events_stream(session, sf)), payments_of(tv.events_stream(session, sf)), unpaid=True
    )
    ev = tv.events(spark, sf)
    orders, payments = tv.minute_orders(ev), payments_of(ev)
    slower = F.least(tv.latest(orders, "event_time"), tv.latest(payments, "event_time"))
    return with_open_orders(_appended(spark, name, joined), orders, payments, slower)


@query
def join_order_payment_stream(spark, sf):
    """Orders joined to their payments as two streams with a time bound; unpaid ones have nulls."""
    return _paid_stream(spark, sf, "paid", tv.payments)


@query
def join_order_failure_stream(spark, sf):
    """The same with failed payments only, which most orders lack."""
    return _paid_stream(spark, sf, "failures", lambda ev: tv.payments(ev).filter(F.col("status") == "failed"))


@query
def gold_session_stream(spark, sf):
    """Sessions closed by the stream, and the open ones from the table."""
    session = streaming_session(spark, Settings())
    measures = gold.session_measures()
    closed = session_stream(tv.events_stream(session, sf), "user_id", "event_time", measures)
    return with_open_sessions(
        _appended(spark, "sessions", closed), tv.events(spark, sf), "user_id", "event_time", measures
    )


@query
def funnel_steps(spark, sf):
    """Users who view, click, order and pay, in this order, within 12 hours of the view."""
    ev = tv.events(spark, sf)
    return analytics.shopping_funnel(tv.clicks(ev, kind=True), tv.minute_orders(ev), tv.payments(ev), 12 * 60)


# Dashboard


def _metric_tables(ev: DataFrame) -> dict[str, DataFrame]:
    orders = tv.minute_orders(ev)
    return {
        "revenue": kpi.revenue_per_minute(orders),
        "users": kpi.active_users_exact(tv.activity(ev)),
        "failed": kpi.failed_payments(tv.payments(ev)),
        "top_products": kpi.top_products(kpi.product_metrics(orders)),
        "geo": kpi.geographic_metrics(orders),
        "clicks": _clickstream(ev),
    }


def _panel(spark: SparkSession, sf: str, name: str, minutes: int = 120) -> DataFrame:
    ev = tv.events(spark, sf)
    return serving.load_metrics(_metric_tables(ev), tv.latest(ev, "event_time"), minutes)[name]


@query
def dashboard_snapshot(spark, sf):
    t = _metric_tables(tv.events(spark, sf))
    return serving.dashboard_snapshot(t["revenue"], t["users"], t["failed"], t["top_products"], t["geo"])


@query
def serve_kpis(spark, sf):
    return _panel(spark, sf, "kpis")


@query
def serve_revenue_ts(spark, sf):
    return _panel(spark, sf, "revenue_ts")


@query
def serve_active_users_ts(spark, sf):
    return _panel(spark, sf, "users_ts")


@query
def serve_top_products(spark, sf):
    return serving.top_product_bars(_panel(spark, sf, "top_products"))


@query
def serve_geo(spark, sf):
    return _panel(spark, sf, "geo")


@query
def serve_clickstream(spark, sf):
    return serving.last_click_windows(_panel(spark, sf, "clicks"))


@query
def serve_has_live_data(spark, sf):
    return _panel(spark, sf, "live")


# Gold


@query
def dedup_orders(spark, sf):
    return gold.dedup_orders(tv.order_events(spark, sf))


@query
def clean_orders(spark, sf):
    return gold.clean_orders(tv.order_events(spark, sf)).select(
        "order_id", "user_id", "product_id", "quantity", "total_amount", "country",
        "order_status_normalized", "order_date",
    )


@query
def gold_daily_revenue(spark, sf):
    return gold.daily_revenue(gold.clean_orders(tv.order_events(spark, sf)))


@query
def gold_product_performance(spark, sf):
    return gold.product_performance(gold.clean_orders(tv.order_events(spark, sf)))


@query
def gold_session_analytics(spark, sf):
    return gold.session_analytics(tv.events(spark, sf))


# Warehouse

LONG_AGO = "1900-01-01"
WIDE_ORDER = ("order_id", "date_key", "order_status", "quantity", "unit_price", "total_amount",
              "shipping_country", "order_timestamp")


def _dim_date(spark, sf):
    return warehouse.dim_date(tv.table(spark, sf, "lineitem"), "l_shipdate")


def _dim_users(spark, sf):
    rows = warehouse.open_versions(tv.user_versions(spark, sf), F.lit(LONG_AGO).cast("timestamp"))
    return warehouse.build_dimension(rows, ["user_id"], "user_key")


def _dim_products(spark, sf):
    rows = warehouse.open_versions(tv.product_rows(spark, sf), F.lit(LONG_AGO).cast("timestamp"))
    return warehouse.build_dimension(rows, ["product_id"], "product_key")


def _user_lookup(spark, sf, counted):
    return warehouse.Dimension(_dim_users(spark, sf), tv.table(spark, sf, "customer"), counted, 1)


def _product_lookup(spark, sf):
    lines = tv.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("product_id"))
    return warehouse.Dimension(_dim_products(spark, sf), tv.table(spark, sf, "part"), lines, 1)


def _facts(spark, sf, users: bool = False, products: bool = False) -> DataFrame:
    clean = gold.clean_orders(tv.order_events(spark, sf))
    buyers = tv.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("user_id"))
    keyed = warehouse.with_dimension_keys(
        clean,
        _user_lookup(spark, sf, buyers) if users else None,
        _product_lookup(spark, sf) if products else None,
    )
    return warehouse.fact_orders(keyed)


def _last_order_day(spark, sf) -> Column:
    return tv.latest(tv.table(spark, sf, "lineitem"), "l_shipdate").cast("date")


@query
def dim_date(spark, sf):
    return _dim_date(spark, sf)


@query
def dim_users(spark, sf):
    return _dim_users(spark, sf)


@query
def dim_products(spark, sf):
    return _dim_products(spark, sf)


@query
def dim_products_seed(spark, sf):
    """The dimension holds the small parts; the whole catalogue comes in."""
    catalogue = tv.product_rows(spark, sf)
    small = tv.table(spark, sf, "part").filter(F.col("p_size") <= 25)
    known = catalogue.join(
        small.select(F.col("p_partkey").cast("string").alias("product_id")), "product_id", "left_semi"
    )
    existing = assign_keys(known, ["product_id"], "product_key")
    added = warehouse.seed_dimension(existing, catalogue, "product_id", "product_key")
    return existing.unionByName(added)


@query
def fact_orders(spark, sf):
    facts = _facts(spark, sf, users=True, products=True)
    return warehouse.number_facts(facts, "order_id", "order_key").drop("etl_loaded_at")


@query
def fact_payments(spark, sf):
    paid = tv.payments(tv.events(spark, sf))
    keyed = warehouse.with_dimension_keys(paid, _user_lookup(spark, sf, paid), None)
    facts = warehouse.fact_payments(keyed)
    return warehouse.number_facts(facts, "payment_id", "payment_key").drop("etl_loaded_at")


def _staged(spark, sf, orders: DataFrame) -> DataFrame:
    return warehouse.stage_daily_revenue(gold.daily_revenue(orders))


@query
def wh_stage_daily_revenue(spark, sf):
    return _staged(spark, sf, gold.clean_orders(tv.order_events(spark, sf))).drop("etl_processed_at")


@query
def wh_fact_orders_replace(spark, sf):
    """Day totals of raw orders are in the table; those of the last 30 days come in cleaned."""
    raw = tv.order_events(spark, sf).withColumn("order_date", F.to_date("event_time"))
    clean = gold.clean_orders(tv.order_events(spark, sf))
    single = _facts(spark, sf).select(*WIDE_ORDER)
    old = warehouse.aggregate_facts(_staged(spark, sf, raw))
    staged = _staged(spark, sf, clean).filter(
        F.col("order_date") >= F.date_sub(_last_order_day(spark, sf), 30)
    )
    return warehouse.replace_aggregates(single.unionByName(old), staged)


def _summary(ev: DataFrame) -> DataFrame:
    orders = tv.minute_orders(ev)
    out = warehouse.daily_summary(kpi.revenue_per_minute(orders), kpi.geographic_metrics(orders))
    return _rounded(out, "avg_minute_aov", "aov")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query
def wh_daily_summary(spark, sf):
    return _summary(tv.events(spark, sf))


@query
def wh_summary_last_day(spark, sf):
    ev = tv.events(spark, sf)
    orders = tv.minute_orders(ev)
    out = warehouse.last_day_summary(
        kpi.revenue_per_minute(orders), kpi.geographic_metrics(orders), tv.latest(ev, "event_time")
    )
    return _rounded(out, "avg_minute_aov")


@query
def wh_daily_summary_upsert(spark, sf):
    """The table was loaded at noon each day; the last seven days come in again in full."""
    ev = tv.events(spark, sf)
    noon = _summary(ev.filter(F.hour("event_time") < 12))
    week = F.date_sub(F.to_date(tv.latest(ev, "event_time")), 7)
    fresh = _summary(ev).filter(F.col("report_date") >= week)
    return warehouse.upsert_summary(noon, fresh)


# Version history and change feed


def _versions(spark, sf):
    return scd2(
        tv.product_changes(spark, sf), ["product_id"], "changed_at", ["rate", "status"],
        ("change_id", "change_line"),
    )


@query
def scd2_products(spark, sf):
    return _versions(spark, sf)


@query
def fact_orders_as_of(spark, sf):
    """Each order line with the key, rate and status of the product version valid on its day."""
    orders = tv.order_events(spark, sf).select("order_id", "product_id", "total_amount", "event_time")
    versions = warehouse.build_dimension(
        _versions(spark, sf), ["product_id", "effective_from"], "product_key"
    )
    # Both the orders and the versions come from the line items, by product and day.
    days = tv.product_changes(spark, sf).select("product_id", F.col("changed_at").alias("event_time"))
    return as_of_lookup(
        orders, versions, ["product_id"], "event_time", ["product_key", "rate", "status"],
        tv.table(spark, sf, "lineitem"), times=days,
    )


CDC_ORDER = schemas.StructType().add("order_id", "long").add("customer_id", "long").add("order_status", "string")


@query
def cdc_silver(spark, sf):
    """The change feed drained into silver and read back."""
    session = streaming_session(spark, Settings())
    root = scratch_path(spark, "silver")
    feed = tv.change_records(
        tv.table_stream(session, sf, "orders"), tv.table_stream(session, sf, "lineitem")
    )
    rows = cdc.silver(feed)
    parts = ("table_name", "year", "month", "day")
    append_stream(rows, f"{root}/cdc", f"{root}/checkpoint", parts).awaitTermination()
    return spark.read.schema(schemas.CDC_SILVER).parquet(f"{root}/cdc").select(
        "cdc_topic", "record_key", "kafka_timestamp", "offset", "operation", "table_name",
        F.coalesce(
            F.get_json_object("payload", "$.after.order_status"), F.get_json_object("payload", "$.order_status")
        ).alias("order_status"),
    )


def _silver(spark, sf):
    return cdc.silver(tv.change_records(tv.table(spark, sf, "orders"), tv.table(spark, sf, "lineitem")))


@query
def cdc_current_state(spark, sf):
    return cdc.current_state(_silver(spark, sf), "orders", CDC_ORDER, ["order_id"])


@query
def cdc_order_history(spark, sf):
    return cdc.history(_silver(spark, sf), "orders", CDC_ORDER, ["order_id"], ["customer_id", "order_status"])


# Analytics


@query
def q1(spark, sf):
    return analytics.daily_trend(
        _facts(spark, sf, users=True), _dim_date(spark, sf), _last_order_day(spark, sf)
    )


@query
def q2(spark, sf):
    return analytics.top_products_of_month(
        _facts(spark, sf, products=True), _dim_products(spark, sf), _last_order_day(spark, sf),
        stored=tv.table(spark, sf, "part"),
    )


@query
def q3(spark, sf):
    """Pending orders have no shipping country yet, so the buyer's is used."""
    facts = _facts(spark, sf, users=True).withColumn(
        "shipping_country", F.when(F.col("order_status") != "p", F.col("shipping_country"))
    )
    return analytics.revenue_by_country(facts, _dim_users(spark, sf), tv.table(spark, sf, "customer"))


@query
def q4(spark, sf):
    ev = tv.events(spark, sf)
    keyed = warehouse.with_dimension_keys(tv.payments(ev), None, None)
    return analytics.payment_failures(warehouse.fact_payments(keyed), tv.latest(ev, "event_time"))


@query
def q5(spark, sf):
    return analytics.monthly_buyers(_facts(spark, sf, users=True), _dim_date(spark, sf))


@query
def q6(spark, sf):
    return analytics.year_over_year(_facts(spark, sf), _dim_date(spark, sf))


@query
def cohort_retention(spark, sf):
    return analytics.cohort_retention(tv.table(spark, sf, "orders"), "o_custkey", "o_orderdate")


@query
def join_purchase_click(spark, sf):
    return analytics.clicks_before_purchase(tv.events(spark, sf)).select(
        "event_id", "user_id", "event_time", "value", "trailing_count", "last_counted_at"
    )


@query
def join_order_payment(spark, sf):
    ev = tv.events(spark, sf)
    return analytics.order_payments(tv.minute_orders(ev), tv.payments(ev))


# Quality


@query
def dq_reconcile(spark, sf):
    """Day totals of the raw orders against gold, which drops repeated orders."""
    raw = tv.order_events(spark, sf)
    streamed = kpi.revenue_per_minute(raw, Settings(window="1 day"))
    daily = gold.daily_revenue(gold.clean_orders(raw))
    return quality.reconcile(
        quality.daily_totals(streamed, F.to_date("window_start"), "total_revenue", "order_count"),
        quality.daily_totals(daily, F.col("order_date"), "total_revenue", "order_count"),
    )


@query
def dq_failed_payment_rate(spark, sf):
    return quality.failed_payment_rate(tv.payments(tv.events(spark, sf)), 50.0)


@query
def dq_orphan_keys(spark, sf):
    """Orders whose product is not among the parts."""
    parts = tv.table(spark, sf, "part")
    return quality.orphan_keys(
        tv.order_events(spark, sf), parts.select(F.col("p_partkey").cast("string").alias("product_id")), "product_id"
    )


@query
def scalar_suite(spark, sf):
    """The scalar functions, one column each, over all orders."""
    d = F.to_date("o_orderdate")
    text = F.format_string('{"op":"u","n":%d}', F.col("o_custkey"))
    return tv.table(spark, sf, "orders").select(
        "o_orderkey",
        scalars.normalized(F.concat(F.lit("  "), "o_orderpriority")).alias("normalized"),
        scalars.table_of_topic(F.concat(F.lit("shop.feed."), "o_orderstatus")).alias("table_name"),
        F.concat_ws("-", F.lit("AGG"), F.date_format(d, "yyyyMMdd"), "o_orderstatus").alias("text_key"),
        date_key(d).alias("date_key"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        d.alias("order_date"),
        F.trunc(d, "month").alias("month_start"),
        F.date_add(d, 30).alias("in_30_days"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week"),
        F.dayofweek(d).alias("weekday"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.to_timestamp("o_orderdate") - F.make_dt_interval(mins=F.lit(30))).alias("half_hour_before"),
        F.round(F.col("o_totalprice") / 7, 2).alias("rounded"),
        scalars.stock_after(F.lit(500), -F.col("o_custkey")).alias("stock"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("pending")).alias("status"),
        F.when(F.col("o_totalprice") > 250000, "large").otherwise("small").alias("size"),
        F.get_json_object(text, "$.op").alias("json_op"),
        F.from_json(text, "n bigint")["n"].alias("json_n"),
    )
