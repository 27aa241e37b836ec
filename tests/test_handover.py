"""From a replay of stored events to the stream, without gap or double count; new folders of a table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.config import Settings
from basketry.functions.parse import parse_events
from basketry.session import streaming_session
from basketry.sources import catalog
from basketry.sources.files import stream_dataset
from basketry.streaming import app, upsert_log
from conftest import rows
from test_stream import order

SETTINGS = Settings(state_partitions=2, max_files_per_trigger=1)


def put(spark, folder, texts, offset):
    data = [(None, t.encode(), "orders", 0, offset + i, None, 0) for i, t in enumerate(texts)]
    parsed = parse_events(spark.createDataFrame(data, schemas.KAFKA), schemas.ORDERS_TOPIC)
    parsed.coalesce(1).write.partitionBy("year", "month", "day").mode("append").parquet(folder)


def read(spark, name, table):
    empty = spark.createDataFrame([], schemas.bronze("orders"))
    schema = app.metric_frame(name, empty, SETTINGS).schema
    return rows(upsert_log.read_table(spark, table, schema, app.METRICS[name].keys))


@pytest.mark.parametrize("name", ["revenue_per_minute", "product_metrics"])
def test_seed_and_stream_equal_one_run(spark, tmp_path, name):
    rnd = random.Random(1)
    session = streaming_session(spark, SETTINGS)
    bronze = f"{tmp_path}/bronze"
    schema = schemas.bronze("orders")

    def events():
        return stream_dataset(session, bronze, schema, 1)

    # Some orders come again within the watermark, one of them just after the cut.
    first = [order(i, i * 20, 1.0 + i, f"p{i % 3}") for i in range(150)] + [order(i, i * 20 + 5, 1.0 + i, f"p{i % 3}") for i in range(0, 150, 10)]
    first.sort(key=lambda t: t.split('"timestamp":')[1])
    later = [order(140 + i, (140 + i) * 20 + rnd.randrange(15), 2.0, f"p{i % 3}") for i in range(60)]
    put(spark, bronze, first, 0)
    stored = spark.read.schema(schema).parquet(bronze)
    cut = app.seed_metric(spark, name, stored, SETTINGS, f"{tmp_path}/seeded")
    assert cut == dt.datetime(2024, 1, 1, 12, 39)
    seeded = read(spark, name, f"{tmp_path}/seeded")
    assert seeded and max(r[0] for r in seeded) < cut
    app.start_metric(name, events(), SETTINGS, f"{tmp_path}/seeded", f"{tmp_path}/cp1", since=cut).awaitTermination()
    put(spark, bronze, later, 1000)
    # A second seed finds the first one and changes nothing.
    assert app.seed_metric(spark, name, spark.read.schema(schema).parquet(bronze), SETTINGS, f"{tmp_path}/seeded") == cut
    app.start_metric(name, events(), SETTINGS, f"{tmp_path}/seeded", f"{tmp_path}/cp1", since=cut).awaitTermination()
    app.start_metric(name, events(), SETTINGS, f"{tmp_path}/plain", f"{tmp_path}/cp2").awaitTermination()
    assert read(spark, name, f"{tmp_path}/seeded") == read(spark, name, f"{tmp_path}/plain")


def test_seed_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], schemas.bronze("orders"))
    assert app.seed_metric(spark, "revenue_per_minute", empty, SETTINGS, f"{tmp_path}/t") is None


def test_only_new_folders_are_registered(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/days"
    schema = schemas._schema("order_id string", "year int", "month int", "day int")
    data = [("a", 2024, 1, 1), ("b", 2024, 1, 2), ("c", 2024, 2, 1), ("d", None, 1, 1)]
    parts = ["year", "month", "day"]

    def write(rows_):
        spark.createDataFrame(rows_, schema).write.partitionBy(*parts).mode("append").parquet(path)

    write(data)
    assert len(catalog.register_dataset(spark, "days_x", path, schema, parts)) == 4
    assert rows(spark.table("days_x"), "order_id") == [("a",), ("b",), ("c",), ("d",)]
    statements, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: statements.append(text) or real(self, text, *a, **k))
    assert catalog.register_dataset(spark, "days_x", path, schema, parts) == []
    assert not any("ADD" in s or "RECOVER" in s for s in statements)
    write([("e", 2024, 1, 2), ("f", 2024, 3, 9)])
    assert catalog.register_dataset(spark, "days_x", path, schema, parts) == ["year=2024/month=3/day=9"]
    assert sum("ADD IF NOT EXISTS" in s for s in statements) == 1
    assert rows(spark.table("days_x"), "order_id") == [("a",), ("b",), ("c",), ("d",), ("e",), ("f",)]


def test_sketches_add_up(spark):
    from basketry.plans import kpi

    start = dt.datetime(2024, 1, 1)
    data = [(f"u{i % 500}", start + dt.timedelta(seconds=i * 7)) for i in range(4000)] + [(None, start)]
    df = spark.createDataFrame(data, "user_id string, event_time timestamp")
    hours = kpi.active_users_over(kpi.user_sketches(df), "1 hour")
    exact = {r.window_start: r.active_user_count for r in kpi.active_users_exact(df, Settings(window="1 hour")).collect()}
    got = {r.window_start: r.active_user_count for r in hours.collect()}
    assert got.keys() == exact.keys() and all(abs(got[w] - n) <= 0.05 * n for w, n in exact.items())
