"""What the optimizer makes of the queries."""

import datetime as dt
import re

import pytest

import testqueries
import testviews as tv
from basketry import schemas
from basketry.functions.dates import between_days
from basketry.operators.ranking import first_per_key
from basketry.plans import gold, kpi, serving


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in testqueries.QUERIES if not n.endswith("_stream") and n not in
               ("bronze_events", "bronze_replay_revenue", "cdc_silver"))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_product(spark, sf, name):
    text = plan(testqueries.QUERIES[name](spark, sf))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "InPandas"):
        assert word not in text


@pytest.mark.parametrize("name", BATCH)
def test_nested_loops_only_against_single_rows(spark, sf, name):
    assert "BroadcastNestedLoopJoin" not in plan(testqueries.QUERIES[name](spark, sf))


def test_scan_reads_only_what_is_needed(spark, sf):
    text = plan(kpi.revenue_per_minute(tv.minute_orders(tv.events(spark, sf))))
    assert "EqualTo(event_type,purchase)" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "user_id" not in read


def test_ranking_cuts_before_the_shuffle(spark, sf):
    text = plan(kpi.top_products(kpi.product_metrics(tv.minute_orders(tv.events(spark, sf)))))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "Partial" in plan(gold.dedup_orders(tv.order_events(spark, sf)))


def test_sums_are_partly_done_before_the_shuffle(spark, sf):
    assert "partial_sum" in plan(gold.daily_revenue(gold.clean_orders(tv.order_events(spark, sf))))


def test_day_filter_skips_folders(spark, tmp_path):
    data = [("a", 2023, 12, 31), ("b", 2024, 1, 1)]
    df = spark.createDataFrame(data, "order_id string, year int, month int, day int")
    df.write.partitionBy("year", "month", "day").parquet(f"{tmp_path}/b")
    day = dt.date(2024, 1, 1)
    picked = spark.read.schema(schemas.bronze("orders")).parquet(f"{tmp_path}/b").filter(between_days(day, day))
    assert picked.count() == 1
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan(picked))


def test_top_n_is_not_a_full_sort(spark, sf):
    ev = tv.events(spark, sf)
    top = kpi.top_products(kpi.product_metrics(tv.minute_orders(ev)))
    assert "TakeOrderedAndProject" in plan(serving.latest_top_products(top, tv.latest(ev, "event_time")))


def test_hot_order_is_cut_where_it_is_read(spark):
    copies = spark.range(0, 20000, 1, 8).selectExpr("'same' as order_id", "id % 7 as v")
    df = first_per_key(copies, ["order_id"], [])
    assert df.count() == 1
