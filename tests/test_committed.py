"""Metric tables: whole batches only, days folded and old folders gone, one window for all panels."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from basketry import jobs, schemas
from basketry.config import Settings
from basketry.sources.kafka import read_record_files
from basketry.streaming import app, upsert_log
from basketry.streaming.runs import Run
from conftest import rows

SCHEMA = "window_start timestamp, k string, v int"
RUN = Run(1)


def frame(spark, *data):
    return spark.createDataFrame([(dt.datetime(2024, 1, d, h), k, v) for d, h, k, v in data], SCHEMA)


def values(df):
    return sorted((r.window_start.day, r.k, r.v) for r in df.collect())


def read(spark, table, **more):
    return upsert_log.read_table(spark, table, frame(spark).schema, ["window_start", "k"], **more)


def fold(spark, table, grace=0):
    upsert_log.fold(spark, table, frame(spark).schema, ["window_start", "k"], grace_seconds=grace)


def files(table):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(table) for name in names)


def test_a_half_written_batch_is_not_seen(spark, tmp_path):
    table = f"{tmp_path}/t"
    upsert_log.write_batch(frame(spark, (1, 0, "a", 1)), 0, table, RUN)
    before = upsert_log.state_of(spark, table)
    # The next batch has written its rows, and its commit line is not there yet.
    later = frame(spark, (1, 0, "a", 2), (2, 0, "b", 2)).withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd"))
    later.write.partitionBy("window_day").parquet(f"{table}/log/upsert_run=1/upsert_batch=1")
    assert values(read(spark, table)) == [(1, "a", 1)] and upsert_log.state_of(spark, table) == before
    # Its second try writes it as a whole.
    upsert_log.write_batch(frame(spark, (1, 0, "a", 2), (2, 0, "b", 2)), 1, table, RUN)
    assert values(read(spark, table)) == [(1, "a", 2), (2, "b", 2)]
    assert values(read(spark, table, state=before)) == [(1, "a", 1)]
    # A batch that is committed is not written again.
    upsert_log.write_batch(frame(spark, (1, 0, "a", 9)), 1, table, RUN)
    assert values(read(spark, table)) == [(1, "a", 2), (2, "b", 2)]


def test_folds_touch_their_days_only(spark, tmp_path):
    table = f"{tmp_path}/t"
    upsert_log.write_batch(frame(spark, (1, 0, "a", 1), (2, 0, "a", 1)), 0, table, RUN)
    fold(spark, table)
    kept = [n for n in os.listdir(f"{table}/days/window_day=2024-01-01/fold=1") if n.endswith(".parquet")]
    upsert_log.write_batch(frame(spark, (2, 0, "a", 2), (3, 0, "b", 1)), 1, table, RUN)
    old = upsert_log.state_of(spark, table)
    fold(spark, table, grace=600)
    assert upsert_log.state_of(spark, table).days == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 2}
    assert [n for n in os.listdir(f"{table}/days/window_day=2024-01-01/fold=1") if n.endswith(".parquet")] == kept
    assert values(read(spark, table)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
    # Within the grace time the state before can still be read.
    assert values(read(spark, table, state=old)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
    upsert_log.sweep(spark, table, 0)
    assert values(read(spark, table)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1)]
    assert not os.path.exists(f"{table}/days/window_day=2024-01-02/fold=1") and not os.listdir(f"{table}/_commits")


def test_files_stay_few(spark, tmp_path):
    table, most = f"{tmp_path}/t", 0
    for batch in range(40):
        upsert_log.write_batch(frame(spark, (1 + batch // 20, batch % 5, "a", batch)).coalesce(1), batch, table, RUN)
        if batch % 4 == 3:
            fold(spark, table)
            most = max(most, files(table))
    assert most <= 2 + 4
    assert values(read(spark, table)) == sorted([(1, "a", v) for v in range(15, 20)] + [(2, "a", v) for v in range(35, 40)])
    assert len(os.listdir(f"{table}/_folds")) <= 4  # the newest manifests, with their checksums


def test_a_day_is_read_from_its_folder(spark, tmp_path):
    table = f"{tmp_path}/t"
    upsert_log.write_batch(frame(spark, (1, 0, "a", 1), (2, 0, "a", 1)), 0, table, RUN)
    fold(spark, table)
    upsert_log.write_batch(frame(spark, (1, 1, "a", 1), (3, 0, "a", 1)), 1, table, RUN)
    got = read(spark, table, first_day=dt.date(2024, 1, 2))
    assert values(got) == [(2, "a", 1), (3, "a", 1)]
    assert not any("2024-01-01" in name for name in got.inputFiles())


def test_tables_without_windows(spark, tmp_path):
    table = f"{tmp_path}/t"
    plain = spark.createDataFrame([("a", 1)], "k string, v int")
    upsert_log.write_batch(plain, 0, table, RUN)
    upsert_log.fold(spark, table, plain.schema, ["k"], grace_seconds=0)
    upsert_log.write_batch(spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int"), 1, table, RUN)
    assert rows(upsert_log.read_table(spark, table, plain.schema, ["k"])) == [("a", 2), ("b", 1)]


START = dt.datetime(2024, 3, 1, 10)


def event(i, topic):
    stamp = (START + dt.timedelta(seconds=20 * i)).isoformat() + "+00:00"
    common = {"user_id": f"u{i % 7}", "country": "DE", "timestamp": stamp}
    return {
        "orders": {"event_type": "order_placed", "order_id": f"o{i}", "product_id": f"p{i % 3}", "product_name": f"P{i % 3}",
                   "quantity": 1, "total_amount": 2.0, **common},
        "payments": {"event_type": "payment_processed", "payment_id": f"p{i}", "order_id": f"o{i}", "amount": 2.0,
                     "status": "failed" if i % 5 == 0 else "success", **common},
        "clicks": {"event_type": "page_view", "event_id": f"e{i}", "session_id": f"s{i % 4}", "page_url": "/x", **common},
        "users": {"event_type": "user_activity", "activity_id": f"a{i}", "activity_type": "login", **common},
        "inventory_updates": {"event_type": "inventory_update", "update_id": f"i{i}", "product_id": f"p{i % 3}",
                              "warehouse_id": "W", "quantity_delta": 1, "previous_stock": 1, "new_stock": 2, **common},
    }[topic]


@pytest.fixture(scope="module")
def application(spark, tmp_path_factory):
    """The whole application over topics that lie in files, run until all is read."""
    root = tmp_path_factory.mktemp("app")
    settings = Settings(lake_root=str(root), state_partitions=2, trigger="", kpi_source="topic", fold_every=2, fold_grace_seconds=0)
    for topic in settings.topics.values():
        for part in range(4):
            data = [(None, json.dumps(event(i, topic)).encode(), topic, 0, i, None, 0) for i in range(part * 15, part * 15 + 15)]
            data += [(None, b"no json", topic, 0, 1000 + part, None, 0)]
            spark.createDataFrame(data, schemas.KAFKA).coalesce(1).write.mode("append").parquet(f"{root}/kafka/{topic}")
    change = b'{"op":"c","after":{"order_id":1}}'
    spark.createDataFrame([(b"k", change, settings.cdc_topics()[2], 0, 0, None, 0)], schemas.KAFKA).write.parquet(f"{root}/kafka/cdc")
    sent = []

    def records_of(session, topics):
        name = topics[0] if topics[0] in settings.topics.values() else "cdc"
        return read_record_files(session, f"{root}/kafka/{name}", 1)

    def publish(name, batch, number):
        sent.append((name, number, batch.count()))

    queries = app.start_all(spark, settings, "earliest", records_of, publish)
    for query in queries:
        query.awaitTermination()
    return settings, queries, sent


def test_application_runs_all_queries(spark, application):
    settings, queries, sent = application
    assert len(queries) == 2 * len(settings.topics) + len(app.METRICS) + 1
    assert all(q.exception() is None for q in queries)
    for topic in settings.topics:
        assert spark.read.parquet(settings.bronze(topic)).count() == 60
        assert spark.read.parquet(settings.dead_letters(topic)).count() == 4
    assert spark.read.parquet(settings.silver("cdc")).count() == 1
    revenue = jobs.metric_table(spark, settings, "revenue_per_minute")
    assert revenue.agg(F.sum("order_count"), F.sum("total_revenue").cast("int")).first()[:] == (60, 120)
    assert {name for name, _, n in sent if n} == set(app.METRICS) - {"returns_by_reason"}
    # The application folds its tables itself.
    assert upsert_log.state_of(spark, settings.metric("revenue_per_minute")).fold >= 2


def test_panels_stand_at_one_window(spark, application):
    settings, *_ = application
    # The table of the products is a minute ahead of the others.
    ahead = dt.datetime(2024, 3, 1, 10, 30)
    schema = jobs.metric_schema(spark, settings, "product_metrics")
    more = spark.createDataFrame([(ahead, "new", "New", 1, 9)], "window_start timestamp, product_id string, product_name string, units_sold bigint, revenue int")
    more = more.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    upsert_log.write_batch(more, 1000, settings.metric("product_metrics"), Run(1))
    panels = jobs.dashboard(spark, settings, dt.datetime(2024, 3, 1, 10, 31), 60)
    kpis = panels["kpis"].first()
    assert kpis.snapshot_time == dt.datetime(2024, 3, 1, 10, 19) and kpis.top_product != "New"
    assert (kpis.total_revenue, kpis.orders_per_minute, kpis.active_users) == (6.0, 3, 3)
    assert panels["revenue_ts"].count() == 20
