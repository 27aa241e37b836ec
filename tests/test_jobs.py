"""The whole way of a small lake: topics, bronze, metrics, gold, warehouse, queries, dashboard."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from basketry import jobs, schemas
from basketry.config import Settings
from basketry.functions.parse import parse_events
from basketry.plans import analytics, quality
from basketry.session import streaming_session
from basketry.sources.files import stream_dataset
from basketry.sources.kafka import read_record_files
from basketry.streaming import app
from basketry.streaming.bronze import append_stream
from conftest import rows

START = dt.datetime(2024, 3, 1)


def events(n=400):
    rnd = random.Random(5)
    out = {"orders": [], "payments": [], "clicks": [], "users": [], "inventory": []}
    for i in range(n):
        t = START + dt.timedelta(minutes=i * 20, seconds=rnd.randrange(60))
        stamp = t.isoformat() + "+00:00"
        user = f"user_{rnd.randrange(20)}"
        product = rnd.randrange(6)
        amount = rnd.randrange(100, 9999) / 100
        order = {
            "event_type": "order_placed", "order_id": f"o{i}", "user_id": user, "product_id": f"SKU-{product}",
            "product_name": f"Product {product}", "category": f"C{product % 2}", "quantity": 1 + product % 3,
            "unit_price": amount, "total_amount": amount, "country": rnd.choice(["DE", "FR"]), "city": "X",
            "order_status": " Pending ", "timestamp": stamp,
        }
        out["orders"].append(order)
        if i % 10 == 0:
            out["orders"].append({**order, "timestamp": (t + dt.timedelta(seconds=1)).isoformat() + "+00:00"})
        if i % 7 == 0:
            out["orders"].append({
                "event_type": "order_returned", "return_id": f"r{i}", "order_id": f"o{i}", "user_id": user,
                "refund_amount": 1.0, "quantity": 1, "reason": "defective", "timestamp": stamp})
        out["payments"].append({
            "event_type": "payment_processed", "payment_id": f"p{i}", "order_id": f"o{i}", "user_id": user,
            "amount": amount, "payment_method": rnd.choice(["card", "cash"]),
            "status": "failed" if i % 5 == 0 else "success",
            "failure_reason": "declined" if i % 5 == 0 else None, "timestamp": stamp})
        out["clicks"].append({
            "event_type": "page_view", "event_id": f"c{i}", "session_id": f"s{i % 9}", "user_id": user,
            "page_url": f"/p{product}", "timestamp": stamp})
        out["users"].append({
            "event_type": "user_activity", "activity_id": f"a{i}", "user_id": user, "activity_type": "login",
            "timestamp": stamp})
        out["inventory"].append({
            "event_type": "inventory_update", "update_id": f"i{i}", "product_id": f"SKU-{product}",
            "warehouse_id": "W1", "quantity_delta": -1, "previous_stock": 5, "new_stock": 4, "timestamp": stamp})
    return out


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake filled through the bronze and metric queries of the application."""
    root = tmp_path_factory.mktemp("lake")
    settings = Settings(lake_root=str(root), state_partitions=2)
    session = streaming_session(spark, settings)
    for topic, made in events().items():
        data = [(None, json.dumps(e).encode(), topic, 0, i, None, 0) for i, e in enumerate(made)]
        source = f"{root}/kafka/{topic}"
        spark.createDataFrame(data, schemas.KAFKA).coalesce(1).write.parquet(source)
        parsed = parse_events(read_record_files(session, source), schemas.TOPIC_SCHEMAS[topic])
        append_stream(parsed, settings.bronze(topic), settings.checkpoint(f"bronze_{topic}")).awaitTermination()
    for name, metric in app.METRICS.items():
        bronze = stream_dataset(session, settings.bronze(metric.topic), schemas.bronze(metric.topic))
        app.start_metric(
            name, bronze, settings, settings.metric(name), settings.checkpoint(f"metric_{name}")
        ).awaitTermination()
    jobs.build_gold(spark, settings)
    jobs.load_warehouse(spark, settings)
    return settings


def test_gold_counts_each_order_once(spark, lake):
    daily = spark.read.schema(schemas.GOLD_DAILY_REVENUE).parquet(lake.gold("daily_revenue"))
    assert daily.agg(F.sum("order_count")).first()[0] == 400
    products = spark.read.parquet(lake.gold("product_performance"))
    assert products.agg(F.sum("order_count")).first()[0] == 400
    sessions = spark.read.parquet(lake.gold("session_analytics"))
    assert sessions.agg(F.sum("purchases"), F.sum("events")).first()[:] == (400, 800)


def test_gold_of_late_days_equals_the_full_one(spark, lake):
    before = rows(spark.read.schema(schemas.GOLD_DAILY_REVENUE).parquet(lake.gold("daily_revenue")))
    jobs.build_gold(spark, lake, dt.date(2024, 3, 4))
    assert rows(spark.read.schema(schemas.GOLD_DAILY_REVENUE).parquet(lake.gold("daily_revenue"))) == before


def test_warehouse_is_complete(spark, lake):
    fact = jobs.read_table(spark, lake, "fact_orders")
    assert fact.count() == 400
    assert fact.filter("user_key is null or product_key is null").count() == 0
    for dim, key in (("dim_users", "user_key"), ("dim_products", "product_key"), ("dim_date", "date_key")):
        assert quality.orphan_keys(fact, jobs.read_table(spark, lake, dim), key).count() == 0
    users = jobs.read_table(spark, lake, "dim_users")
    assert users.filter("is_current").count() == 20
    assert users.groupBy("user_id").agg(F.count_distinct("first_seen_date").alias("n")).filter("n > 1").count() == 0
    assert jobs.read_table(spark, lake, "fact_payments").count() == 400
    assert jobs.read_table(spark, lake, "stg_daily_revenue").count() > 0


def test_fact_scan_skips_days(spark, lake):
    fact = jobs.read_table(spark, lake, "fact_orders").filter("date_key = 20240302")
    assert "PartitionFilters: [isnotnull(date_key" in fact._jdf.queryExecution().executedPlan().toString()
    assert fact.count() == 72


def test_queries_run_on_the_stored_tables(spark, lake):
    t = {n: jobs.read_table(spark, lake, n) for n in
         ("fact_orders", "fact_payments", "dim_date", "dim_users", "dim_products")}
    day = dt.date(2024, 3, 6)
    assert analytics.daily_trend(t["fact_orders"], t["dim_date"], day).count() == 6
    assert analytics.top_products_of_month(t["fact_orders"], t["dim_products"], day).count() > 0
    assert analytics.revenue_by_country(t["fact_orders"], t["dim_users"]).count() == 2
    assert {r.payment_method for r in analytics.payment_failures(t["fact_payments"], day).collect()} == {"card", "cash"}
    assert analytics.monthly_buyers(t["fact_orders"], t["dim_date"]).first().active_buyers > 0
    assert analytics.year_over_year(t["fact_orders"], t["dim_date"]).count() == 1


def test_summary_upsert_and_dashboard(spark, lake):
    jobs.refresh_summary(spark, lake, dt.date(2024, 3, 3))
    table = spark.read.parquet(jobs.table_path(lake, "daily_summary"))
    assert table.agg(F.min("report_date")).first()[0] == dt.date(2024, 3, 3)
    jobs.refresh_summary(spark, lake, dt.date(2024, 3, 1))
    again = spark.read.parquet(jobs.table_path(lake, "daily_summary"))
    assert again.count() == 6 and again.agg(F.sum("order_count")).first()[0] == 400
    as_of = jobs.metric_table(spark, lake, "revenue_per_minute").agg(F.max("window_end")).first()[0]
    panels = jobs.dashboard(spark, lake, as_of, 120)
    assert panels["live"].first().has_live_data is True
    assert panels["revenue_ts"].count() >= 5
    assert panels["kpis"].first().top_country in ("DE", "FR")
    assert panels["clicks"].count() >= 2


def test_late_repeats_and_new_members(spark, tmp_path):
    """A run over the last days equals a full one, and stored keys stay."""
    settings = Settings(lake_root=str(tmp_path), state_partitions=2)
    session = streaming_session(spark, settings)
    source = f"{tmp_path}/kafka/orders"

    def arrive(n, made):
        data = [(None, json.dumps(e).encode(), "orders", 0, n * 100 + i, None, 0) for i, e in enumerate(made)]
        spark.createDataFrame(data, schemas.KAFKA).coalesce(1).write.mode("append").parquet(source)
        parsed = parse_events(read_record_files(session, source), schemas.TOPIC_SCHEMAS["orders"])
        append_stream(parsed, settings.bronze("orders"), settings.checkpoint("bronze_orders")).awaitTermination()

    def order(i, day, user, amount, order_id="o"):
        return {
            "event_type": "order_placed", "order_id": order_id and f"{order_id}{i}", "user_id": user, "product_id": f"p{i % 3}",
            "product_name": "x", "category": "c", "quantity": 1, "unit_price": 1.0, "total_amount": amount,
            "country": "DE", "city": "X", "order_status": "new", "timestamp": f"2024-03-{day:02}T10:{i:02}:00+00:00",
        }

    def stored():
        names = ("daily_revenue", "product_performance", "session_analytics")
        return [rows(spark.read.parquet(settings.gold(n))) for n in names]

    def keys(name, natural, key):
        return {tuple(r[:-1]): r[-1] for r in jobs.read_table(spark, settings, name).select(*natural, key).collect()}

    members = [("dim_users", ["user_id", "effective_from"], "user_key"), ("fact_orders", ["order_id"], "order_key")]
    arrive(0, [order(i, 1, f"u{i}", 5.0) for i in range(30)] + [order(30, 1, "u1", 0.0), order(31, 1, "u1", 5.0, None)])
    jobs.build_gold(spark, settings)
    jobs.load_warehouse(spark, settings)
    before = [keys(*m) for m in members]
    # Ten days later: repeats, one of them of an order without amount, and new users.
    arrive(1, [order(i, 11, f"u{i}", 5.0) for i in range(5)] + [order(30, 11, "u1", 9.0), order(32, 11, "u1", 5.0, None)]
           + [order(i, 11, f"v{i}", 5.0) for i in range(33, 50)])
    late = dt.date(2024, 3, 11)
    jobs.build_gold(spark, settings, late)
    jobs.load_warehouse(spark, settings, first_day=late)
    part = stored()
    after = [keys(*m) for m in members]
    for old, new in zip(before, after):
        assert old.items() <= new.items() and len(new) == len(old) + 17 and len(set(new.values())) == len(new)
    fact = jobs.read_table(spark, settings, "fact_orders")
    assert quality.orphan_keys(fact, jobs.read_table(spark, settings, "dim_users"), "user_key").count() == 0
    jobs.build_gold(spark, settings)
    jobs.load_warehouse(spark, settings)
    assert stored() == part and [keys(*m) for m in members] == after


def test_stored_orders_are_read_without_a_shuffle(spark, lake):
    orders = jobs.silver_orders(spark, lake).filter(F.col("order_date") >= dt.date(2024, 3, 4))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "order_date" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_aggregates_are_replaced_by_day(spark, lake):
    jobs.load_aggregates(spark, lake)

    def daily():
        df = spark.read.schema(jobs.AGGREGATES).parquet(jobs.table_path(lake, "fact_daily"))
        return rows(df.select("order_id", "date_key", "quantity", F.col("total_amount").cast("string")))

    before = daily()
    staged = jobs.read_table(spark, lake, "stg_daily_revenue")
    assert len(before) == staged.count() and sum(r[2] for r in before) == 400
    jobs.load_aggregates(spark, lake, dt.date(2024, 3, 4))
    assert daily() == before


def test_catalog_knows_the_lake(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    jobs.load_aggregates(spark, lake)
    first = jobs.publish_catalog(spark, lake, "shop")
    assert len(first["fact_orders"]) == 6 and first["dim_users"] == []
    assert spark.table("shop.fact_orders").count() == 400 and spark.table("shop.bronze_orders").count() == 498
    stats = spark.sql("DESCRIBE EXTENDED shop.fact_orders").filter("col_name = 'Statistics'").first()
    assert "400 rows" in stats.data_type
    assert not any(jobs.publish_catalog(spark, lake, "shop").values())
