import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.upsert import replace_by_key, rows_to_insert, upsert
from basketry.plans import analytics, gold, kpi, quality, serving, warehouse
from basketry.streaming.tables import replace_partitions, write_ranked
from conftest import rows
import testqueries


def test_upsert_lets_a_null_win(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    s = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "k int, x string, y int")
    assert rows(upsert(t, s, ["k"])) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]
    assert rows(upsert(t, s, ["k"], update=["y"])) == [(1, "a", 1), (2, "b", 9), (3, "c", 3)]
    assert rows(rows_to_insert(t, s, ["k"])) == [(3, "c", 3)]
    assert rows(replace_by_key(t, s, ["k"])) == [(1, "a", 1), (2, None, 9), (3, "c", 3)]


def test_replace_partitions_leaves_other_days(spark, tmp_path):
    path = f"{tmp_path}/gold"
    schema = "order_date date, v int"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    replace_partitions(spark.createDataFrame([(d1, 1), (d2, 2), (d2, 3)], schema), path, ["order_date"], f"{tmp_path}/s1")
    # The new rows are read from the table that is replaced.
    current = spark.read.schema(schema).parquet(path)
    replace_partitions(
        current.filter(F.col("order_date") == d2).withColumn("v", F.col("v") * 10), path, ["order_date"],
        f"{tmp_path}/s2", ["v"],
    )
    assert rows(spark.read.schema(schema).parquet(path).select("order_date", "v")) == [(d1, 1), (d2, 20), (d2, 30)]


def test_ranked_table(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id as double) v")
    write_ranked(df, f"{tmp_path}/t", "v", f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 100


def test_dim_date(spark):
    days = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 6),)], "d date")
    holidays = spark.createDataFrame([(dt.date(2024, 1, 1),)], "full_date date")
    dim = warehouse.dim_date(days, "d", holidays)
    assert dim.schema.names == schemas.DIM_DATE.names and dim.count() == 7
    r = dim.filter("date_key = 20240101").first()
    assert (r.quarter, r.month_name, r.week_of_year, r.day_of_week, r.day_name, r.is_weekend, r.is_holiday) == (
        1, "January", 1, 2, "Monday", False, True)
    assert dim.filter("is_weekend").count() == 2
    assert warehouse.dim_date(days.filter("false"), "d").count() == 0


def test_all_fact_keys_are_known(spark, sf):
    q = testqueries
    facts = q._facts(spark, sf, users=True, products=True)
    assert facts.filter("user_key is null or product_key is null").count() == 0
    for dim, key in ((q._dim_users, "user_key"), (q._dim_products, "product_key"), (q._dim_date, "date_key")):
        assert quality.orphan_keys(facts, dim(spark, sf), key).count() == 0


def test_fact_columns_follow_the_table(spark, sf):
    facts = warehouse.number_facts(testqueries._facts(spark, sf, users=True), "order_id", "order_key")
    assert facts.columns == schemas.FACT_ORDERS.names
    assert facts.schema["total_amount"].dataType == schemas.FACT_ORDERS["total_amount"].dataType


def test_dedup_keeps_the_earliest(spark):
    t = dt.datetime(2024, 1, 1)
    data = [("o", t + dt.timedelta(days=1), 5.0, " New "), ("o", t, 7.0, "NEW"), ("p", t, 0.0, "x"), ("q", t, None, "x")]
    df = spark.createDataFrame(data, "order_id string, event_time timestamp, total_amount double, order_status string")
    got = gold.clean_orders(df)
    assert rows(got, "order_id", "total_amount", "order_date", "order_status_normalized") == [("o", 7.0, t.date(), "new")]


def test_summary_of_a_minute_without_orders(spark):
    t = dt.datetime(2024, 1, 1)
    revenue = spark.createDataFrame([(t, 10.0, 2), (t, 0.0, 0)], "window_start timestamp, total_revenue double, order_count bigint")
    geo = spark.createDataFrame([(t, "DE")], "window_start timestamp, country string")
    r = warehouse.daily_summary(revenue, geo).first()
    assert (r.total_revenue, r.order_count, r.avg_minute_aov, r.aov, r.unique_countries) == (10.0, 2, 5.0, 5.0, 1)
    empty = warehouse.last_day_summary(revenue.filter("false"), geo, F.lit(t)).first()
    assert (empty.total_revenue, empty.order_count, empty.avg_minute_aov) == (0.0, 0, 0.0)


def test_year_without_a_previous_one(spark):
    fact = spark.createDataFrame(
        [(20230105, 0), (20240105, 50), (20250105, 75)], "date_key int, total_amount int"
    ).withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)"))
    days = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2025, 12, 31),)], "d date")
    got = analytics.year_over_year(fact, warehouse.dim_date(days, "d"))
    assert [(r.year, r.yoy_growth_pct) for r in got.collect()] == [(2025, 50.0), (2024, None), (2023, None)]


def test_aggregates_never_touch_single_orders(spark):
    t = dt.datetime(2024, 1, 1)
    data = [("o1", 20240101, "new", 1), ("AGG-x", 20240101, "aggregated", 2), ("AGG-y", 20240102, "aggregated", 3)]
    facts = spark.createDataFrame(data, "order_id string, date_key int, order_status string, total_amount int")
    facts = facts.selectExpr(
        "order_id", "date_key", "order_status", "cast(total_amount as decimal(14,2)) total_amount", "1 quantity",
        "cast(1 as decimal(12,2)) unit_price", "'DE' shipping_country", "timestamp'2024-01-01' order_timestamp",
    )
    gold_rows = spark.createDataFrame([(t.date(), "DE", "toys", 9.0, 3, 3.0, 2)], schemas.GOLD_DAILY_REVENUE)
    got = warehouse.replace_aggregates(facts, warehouse.stage_daily_revenue(gold_rows))
    assert rows(got, "order_id", "total_amount") == [
        ("AGG-2024-01-01-DE-toys", 9), ("AGG-y", 3), ("o1", 1)]


def test_reconcile_states(spark):
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    s = spark.createDataFrame([(d[0], 10.0, 1), (d[1], 5.0, 1)], "report_date date, revenue double, orders bigint")
    b = spark.createDataFrame([(d[0], 10.0, 1), (d[2], 5.0, 1)], "report_date date, revenue double, orders bigint")
    assert rows(quality.reconcile(s, b), "report_date", "status") == [
        (d[0], "ok"), (d[1], "missing in batch"), (d[2], "missing in stream")]


def test_dashboard_without_data(spark):
    empty = spark.createDataFrame([], schemas.bronze("orders"))
    payments = spark.createDataFrame([], schemas.bronze("payments"))
    revenue, geo = kpi.revenue_per_minute(empty), kpi.geographic_metrics(empty)
    snap = serving.dashboard_snapshot(
        revenue, kpi.active_users_exact(empty), kpi.failed_payments(payments),
        kpi.top_products(kpi.product_metrics(empty)), geo)
    r = serving.kpi_cards(snap).first()
    assert (r.total_revenue, r.orders_per_minute, r.active_users, r.failed_payments, r.top_product, r.top_country) == (
        0.0, 0, 0, 0, "N/A", "N/A")
    assert serving.has_live_data(revenue).first().has_live_data is False


def test_payment_retries_count_per_order(spark):
    t = dt.datetime(2024, 1, 1)
    m = dt.timedelta(minutes=1)
    orders = spark.createDataFrame([("o", "u", t, 5.0), ("lonely", "u", t, 6.0)], "order_id string, user_id string, event_time timestamp, total_amount double")
    pays = spark.createDataFrame(
        [("o", t + m, "failed", 5.0)] * 40 + [("o", t + 2 * m, "success", 5.0), ("o", t + 11 * m, "success", 5.0), ("o", t - m, "failed", 5.0), (None, t, "failed", 1.0)],
        "order_id string, event_time timestamp, status string, amount double")
    got = rows(analytics.order_payments(orders, pays), "order_id", "attempts", "failures", "paid_amount")
    assert got == [("lonely", 0, 0, 0), ("o", 41, 40, 5)]


def test_replaced_days_leave_rows_without_a_day(spark, tmp_path):
    from basketry.streaming.tables import replace_since

    schema, path = "v int, day date", f"{tmp_path}/t"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    replace_since(spark.createDataFrame([(1, days[0]), (2, days[1]), (3, days[2]), (4, None)], schema), path, "day", None, f"{tmp_path}/s")
    replace_since(spark.createDataFrame([(5, days[1]), (6, None)], schema), path, "day", days[1], f"{tmp_path}/s")
    assert rows(spark.read.schema(schema).parquet(path), "v") == [(1,), (5,), (6,)]
    replace_since(spark.createDataFrame([(7, days[2])], schema), path, "day", days[2], f"{tmp_path}/s")
    assert rows(spark.read.schema(schema).parquet(path), "v") == [(1,), (5,), (6,), (7,)]
