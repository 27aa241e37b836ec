"""Approximate counts hold in every one of many windows, small and large."""

import pytest
from pyspark.sql import functions as F

import testqueries
import testviews as tv
from basketry.plans import kpi

CHECKS = ("kpi_active_users_approx_check", "kpi_active_users_approx_stream_check", "kpi_clickstream_stream")


@pytest.fixture(scope="module")
def many_windows(spark, tmp_path_factory):
    """A folder with views of 13 users a minute over two days, and of 3,000 in one more minute."""
    place = str(tmp_path_factory.mktemp("windows"))
    n, dense = 13 * 2880, 3000
    event = spark.range(n + dense)
    minute = F.least(F.floor(F.col("id") / 13), F.lit(2880))
    seen = F.timestamp_seconds(F.lit(1704067200) + minute * 60 + F.col("id") % 13).cast("timestamp_ntz")
    rows = event.select(
        F.col("id").alias("event_id"), seen.alias("ts"), (F.col("id") * 7919).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    rows.write.parquet(f"{place}/events.parquet")
    return place


@pytest.mark.parametrize("name", CHECKS)
def test_every_window_is_within_its_bound(spark, many_windows, name):
    got = testqueries.QUERIES[name](spark, many_windows)
    assert got.count() == 2881
    assert got.filter("not within").count() == 0


def test_hours_and_days_are_within_five_percent(spark, many_windows):
    activity = tv.activity(tv.events(spark, many_windows))
    got = kpi.active_users_over(kpi.user_sketches(activity), "1 hour")
    exact = activity.groupBy(F.date_trunc("hour", "event_time").alias("window_start")).agg(
        F.count_distinct("user_id").alias("n")
    )
    off = F.abs(F.col("active_user_count") - F.col("n")) > 0.05 * F.col("n")
    joined = got.join(exact, "window_start")
    assert joined.count() == 49 and joined.filter(off).count() == 0


def test_an_empty_user_id_is_a_user(spark):
    rows = spark.createDataFrame([("", 0), ("a", 1), (None, 2)], "user_id string, s int")
    rows = rows.withColumn("event_time", F.timestamp_seconds("s"))
    assert [r.active_user_count for r in kpi.active_users_approx(rows).collect()] == [2]
