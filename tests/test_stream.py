"""Streams: same result as tables, whatever the micro-batches; restarts; late data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.config import Settings
from basketry.functions.parse import of_type, parse_events
from basketry.plans import kpi
from basketry.sources.files import ensure_folder, stream_dataset
from basketry.sources.kafka import read_record_files
from basketry.streaming import app, upsert_log
from basketry.streaming.bronze import append_stream, compact_days, late_rows, read_bronze
from basketry.streaming.joins import dedup_stream
from basketry.streaming.runs import PairingError, open_run
from basketry.session import streaming_session
from conftest import rows

SETTINGS = Settings(state_partitions=2)


@pytest.fixture
def session(spark):
    return streaming_session(spark, SETTINGS)


def order(i, second, amount=1.0, product="p1", country="DE"):
    time = dt.datetime(2024, 1, 1, 12) + dt.timedelta(seconds=second)
    return (
        '{"event_type":"order_placed","order_id":"o%d","user_id":"u","product_id":"%s","product_name":"n",'
        '"quantity":1,"total_amount":%s,"country":"%s","timestamp":"%s+00:00"}'
        % (i, product, amount, country, time.isoformat())
    )


def write_records(spark, folder, texts, offset):
    data = [(None, t.encode(), "orders", 0, offset + i, None, 0) for i, t in enumerate(texts)]
    spark.createDataFrame(data, schemas.KAFKA).coalesce(1).write.mode("append").parquet(folder)


def write_batches(spark, folder, batches):
    n = 0
    for texts in batches:
        write_records(spark, folder, texts, n)
        n += len(texts)


def stream_of(session, folder):
    return parse_events(read_record_files(session, folder, 1), schemas.ORDERS_TOPIC)


def batch_of(spark, folder):
    return parse_events(spark.read.schema(schemas.KAFKA).parquet(folder), schemas.ORDERS_TOPIC)


# One window is spread over all files, so it is sent again and again.
BATCHES = [
    [order(0, 0), order(1, 5, 2.5, "p2"), order(2, 70)],
    [order(3, 10, 4.0), order(4, 15, 1.5, "p2", "FR")],
    [order(5, 20, 8.0, "p3"), order(6, 130)],
]


def metric_schema(name, events):
    return app.metric_frame(name, events, SETTINGS).schema


@pytest.mark.parametrize("name", ["revenue_per_minute", "geographic_metrics", "product_metrics"])
def test_reemitted_windows_match_batch(spark, session, tmp_path, name):
    src, table, cp = (f"{tmp_path}/{x}" for x in ("src", "table", "cp"))
    write_batches(spark, src, BATCHES)
    query = app.start_metric(name, stream_of(session, src), SETTINGS, table, cp)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 3
    want = app.metric_frame(name, batch_of(spark, src), SETTINGS)
    got = upsert_log.read_table(spark, table, want.schema, app.METRICS[name].keys)
    assert rows(got) == rows(want)
    log = spark.read.parquet(f"{table}/log")
    assert log.count() > want.count()


def test_restart_continues_and_fold_keeps_rows(spark, session, tmp_path):
    src, table, cp = (f"{tmp_path}/{x}" for x in ("src", "table", "cp"))
    name, keys = "revenue_per_minute", ("window_start",)
    write_batches(spark, src, BATCHES[:2])
    app.start_metric(name, stream_of(session, src), SETTINGS, table, cp).awaitTermination()
    schema = metric_schema(name, batch_of(spark, src))
    before = rows(upsert_log.read_table(spark, table, schema, keys))
    upsert_log.fold(spark, table, schema, keys, 1, 1)
    assert rows(upsert_log.read_table(spark, table, schema, keys)) == before
    write_records(spark, src, BATCHES[2], 50)
    app.start_metric(name, stream_of(session, src), SETTINGS, table, cp).awaitTermination()
    want = rows(kpi.revenue_per_minute(batch_of(spark, src)))
    assert rows(upsert_log.read_table(spark, table, schema, keys)) == want
    upsert_log.fold(spark, table, schema, keys, 1, 3)
    assert rows(upsert_log.read_table(spark, table, schema, keys)) == want


def test_repeated_batch_changes_nothing(spark, tmp_path):
    table = f"{tmp_path}/t"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    newer = spark.createDataFrame([("a", 5)], "k string, v int")
    run = open_run(spark, table, "cp1")
    assert open_run(spark, table, "cp1") == run and run.number == 1
    for frame, batch in ((df, 0), (newer, 1), (newer, 1), (df, 0)):
        upsert_log.write_batch(frame, batch, table, run)
    assert rows(upsert_log.read_table(spark, table, df.schema, ["k"])) == [("a", 5), ("b", 2)]
    later = open_run(spark, table, "cp2")
    assert later.number == 2
    upsert_log.write_batch(spark.createDataFrame([("b", 9)], "k string, v int"), 0, table, later)
    assert rows(upsert_log.read_table(spark, table, df.schema, ["k"])) == [("a", 5), ("b", 9)]


def test_batch_is_shared_with_a_second_sink(spark, session, tmp_path):
    src, table, cp = (f"{tmp_path}/{x}" for x in ("src", "table", "cp"))
    write_batches(spark, src, BATCHES)
    seen = []
    metric = app.metric_frame("revenue_per_minute", stream_of(session, src), SETTINGS)
    upsert_log.upsert_stream(metric, table, cp, also=lambda df, i: seen.append((i, df.count()))).awaitTermination()
    assert [n for _, n in seen if n] == [2, 1, 2]


def test_late_rows_leave_metrics_but_stay_in_bronze(spark, session, tmp_path):
    src, bronze, table = (f"{tmp_path}/{x}" for x in ("src", "bronze", "table"))
    # The third file moves the watermark; the fourth holds a row whose window has ended
    # before that watermark and one whose window has not.
    write_batches(spark, src, [
        [order(0, 0)], [order(1, 1200)], [order(2, 1260)], [order(3, 30, 7.0), order(4, 1201, 3.0)],
    ])
    append_stream(stream_of(session, src), bronze, f"{tmp_path}/cp_b").awaitTermination()
    query = app.start_metric("revenue_per_minute", stream_of(session, src), SETTINGS, table, f"{tmp_path}/cp_m")
    query.awaitTermination()
    assert late_rows(query) == 1
    schema = metric_schema("revenue_per_minute", batch_of(spark, src))
    got = upsert_log.read_table(spark, table, schema, ["window_start"])
    assert sorted((float(r.total_revenue), r.order_count) for r in got.collect()) == [(1.0, 1), (1.0, 1), (4.0, 2)]
    kept = spark.read.schema(schemas.bronze("orders")).parquet(bronze)
    assert kept.count() == 5
    # Replayed as a table, nothing is late.
    replayed = kpi.revenue_per_minute(of_type(kept, "order_placed"))
    assert sum(r.order_count for r in replayed.collect()) == 5


def test_metrics_can_read_bronze_as_a_stream(spark, session, tmp_path):
    src, bronze, table = (f"{tmp_path}/{x}" for x in ("src", "bronze", "table"))
    write_batches(spark, src, BATCHES)
    ensure_folder(session, bronze)
    append_stream(stream_of(session, src), bronze, f"{tmp_path}/cp_b").awaitTermination()
    events = stream_dataset(session, bronze, schemas.bronze("orders"))
    app.start_metric("revenue_per_minute", events, SETTINGS, table, f"{tmp_path}/cp_m").awaitTermination()
    want = kpi.revenue_per_minute(batch_of(spark, src))
    assert rows(upsert_log.read_table(spark, table, want.schema, ["window_start"])) == rows(want)


def test_exact_users_come_when_windows_close(spark, session, tmp_path):
    src, table = f"{tmp_path}/src", f"{tmp_path}/table"
    write_batches(spark, src, [[order(0, 0), order(1, 10), order(2, 70)], [order(3, 3000)]])
    events = stream_of(session, src)
    app.start_metric("active_users_exact", events, SETTINGS, table, f"{tmp_path}/cp").awaitTermination()
    got = upsert_log.read_table(spark, table, metric_schema("active_users_exact", batch_of(spark, src)), ["window_start"])
    assert [(r.window_start.minute, r.active_user_count) for r in got.orderBy("window_start").collect()] == [(0, 1), (1, 1)]


def test_sink_refuses_a_lost_checkpoint(spark, session, tmp_path):
    src, bronze = f"{tmp_path}/src", f"{tmp_path}/bronze"
    write_batches(spark, src, BATCHES)
    append_stream(stream_of(session, src), bronze, f"{tmp_path}/cp").awaitTermination()
    with pytest.raises(PairingError):
        append_stream(stream_of(session, src), bronze, f"{tmp_path}/cp_new")
    append_stream(stream_of(session, src), bronze, f"{tmp_path}/cp").awaitTermination()
    assert spark.read.schema(schemas.bronze("orders")).parquet(bronze).count() == 7


def test_compacted_days_read_as_one(spark, session, tmp_path):
    src, live, packed = (f"{tmp_path}/{x}" for x in ("src", "live", "packed"))
    write_batches(spark, src, [[order(0, 0), order(1, 90000)], [order(2, 5), order(3, 200000)]])
    append_stream(stream_of(session, src), live, f"{tmp_path}/cp").awaitTermination()
    schema = schemas.bronze("orders")
    day = dt.date(2024, 1, 1)
    compact_days(spark, live, packed, schema, day, day)
    compact_days(spark, live, packed, schema, day, day)
    assert spark.read.schema(schema).parquet(packed).count() == 2
    boundary = dt.date(2024, 1, 2)
    both = read_bronze(spark, live, packed, schema, boundary)
    assert rows(both, "order_id") == [("o0",), ("o1",), ("o2",), ("o3",)]
    assert len({f for f in both.filter("day = 1").inputFiles() if "day=1" in f and "packed" in f}) == 1


def test_dedup_within_watermark(spark, session, tmp_path):
    src = f"{tmp_path}/src"
    write_batches(spark, src, [[order(0, 0), order(0, 1)], [order(0, 2), order(1, 3)]])
    deduped = dedup_stream(stream_of(session, src), ["order_id"])
    append_stream(deduped, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert rows(spark.read.schema(schemas.bronze("orders")).parquet(f"{tmp_path}/out"), "order_id") == [("o0",), ("o1",)]


def test_events_without_an_id_are_no_repeats(spark, session, tmp_path):
    src, table = f"{tmp_path}/src", f"{tmp_path}/table"
    nameless = [order(0, s).replace('"order_id":"o0"', '"order_id":null') for s in (0, 1, 1)]
    write_batches(spark, src, [[*nameless[:2], order(7, 2)], [nameless[2], order(7, 3)]])
    app.start_metric("revenue_per_minute", stream_of(session, src), SETTINGS, table, f"{tmp_path}/cp").awaitTermination()
    schema = metric_schema("revenue_per_minute", batch_of(spark, src))
    got = upsert_log.read_table(spark, table, schema, ["window_start"]).first()
    # Three events without an id, at different places of the topic, and one order told twice.
    assert (float(got.total_revenue), got.order_count) == (4.0, 1)


def test_a_wrong_clock_does_not_stop_the_metrics(spark, session, tmp_path):
    settings = Settings(lake_root=str(tmp_path), state_partitions=2)
    arrived = dt.datetime(2024, 1, 1, 12, 1)
    texts = [order(0, 0), order(1, 86400 * 365 * 75), order(2, 10), "no json"]
    for i, text in enumerate(texts):
        row = [(None, text.encode(), "orders", 0, i, arrived, 0)]
        spark.createDataFrame(row, schemas.KAFKA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    records = read_record_files(session, f"{tmp_path}/src", 1)
    events = parse_events(records, schemas.ORDERS_TOPIC, settings.max_ahead_minutes)
    query = app.start_metric("revenue_per_minute", events, settings, f"{tmp_path}/table", f"{tmp_path}/cp")
    query.awaitTermination()
    assert late_rows(query) == 0
    schema = metric_schema("revenue_per_minute", batch_of(spark, f"{tmp_path}/src"))
    got = upsert_log.read_table(spark, f"{tmp_path}/table", schema, ["window_start"])
    assert rows(got.select(F.minute("window_start").alias("m"), "order_count")) == [(0, 2)]
    app.start_dead_letters("orders", records, settings).awaitTermination()
    bad = spark.read.parquet(settings.dead_letters("orders"))
    assert rows(bad, "offset", "reason") == [(1, "ahead of its arrival"), (3, "no timestamp")]


def test_output_modes_and_keys_of_all_metrics(spark):
    for name, metric in app.METRICS.items():
        empty = spark.createDataFrame([], schemas.bronze(metric.topic))
        frame = app.metric_frame(name, empty, SETTINGS)
        assert set(metric.keys) <= set(frame.columns), name
        assert metric.mode in ("update", "append")


def test_change_feed_query(spark, session, tmp_path):
    settings = Settings(lake_root=str(tmp_path), state_partitions=2)
    topic = "ecommerce_cdc.ecommerce_cdc.products"
    data = [(b"k", text, topic, 0, i, None, 0) for i, text in enumerate([b'{"op":"c","after":{"product_id":1}}', None])]
    spark.createDataFrame(data, schemas.KAFKA).coalesce(1).write.parquet(f"{tmp_path}/feed")
    app.start_cdc(session, settings, read_record_files(session, f"{tmp_path}/feed")).awaitTermination()
    silver = spark.read.schema(schemas.CDC_SILVER).parquet(settings.silver("cdc"))
    assert rows(silver, "table_name", "operation") == [("products", "c"), ("products", "t")]
    assert all("table_name=products/year=" in f for f in silver.inputFiles())


def test_inventory_keeps_last_stock(spark):
    data = [("a", "W1", -3, 10, 7, 0), ("b", "W1", 5, 7, 12, 50), ("c", "W2", -1, 4, 3, 10)]
    df = spark.createDataFrame(data, "update_id string, warehouse_id string, quantity_delta int, previous_stock int, new_stock int, s int")
    df = df.withColumn("event_time", F.timestamp_seconds("s")).withColumn("product_id", F.lit("p"))
    got = rows(kpi.inventory_changes(df), "warehouse_id", "update_count", "net_delta", "last_stock")
    assert got == [("W1", 2, 2, 12), ("W2", 1, -1, 3)]
