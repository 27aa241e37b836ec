"""Change records of both shapes, deletes, tombstones, new inserts, equal times."""

import datetime as dt

from pyspark.sql import functions as F

from basketry import schemas
from basketry.plans import cdc
from conftest import rows

T0 = dt.datetime(2024, 1, 1)
TOPIC = "ecommerce_cdc.ecommerce_cdc.orders"
SCHEMA = schemas.CDC_ROWS["orders"]


def feed(spark, changes):
    data = [
        (b'{"order_id":%d}' % key, text and text.encode(), TOPIC, 0, offset, T0 + dt.timedelta(seconds=s), 0)
        for offset, (key, s, text) in enumerate(changes)
    ]
    return spark.createDataFrame(data, schemas.KAFKA)


CHANGES = [
    (1, 0, '{"op":"c","before":null,"after":{"order_id":1,"order_status":"new","total_amount":"12.50"},"source":{"table":"orders"}}'),
    (2, 1, '{"order_id":2,"order_status":"new","__deleted":"false"}'),
    (1, 2, '{"order_id":1,"order_status":"shipped","__deleted":"false"}'),
    (3, 3, '{"op":"r","after":{"order_id":3,"order_status":"old"}}'),
    (2, 4, '{"order_id":2,"order_status":"new","__deleted":"true"}'),
    (2, 4, None),
    (3, 5, '{"op":"d","before":{"order_id":3,"order_status":"old"},"after":null}'),
    (3, 6, '{"op":"c","after":{"order_id":3,"order_status":"again"}}'),
    (4, 7, '{"op":"c","after":{"order_id":4,"order_status":"first"}}'),
    (4, 7, '{"op":"u","after":{"order_id":4,"order_status":"second"}}'),
    (4, 8, '{"op":"u","after":{"order_id":4,"order_status":"second"}}'),
]


def test_silver(spark):
    got = cdc.silver(feed(spark, CHANGES), F.lit(T0)).orderBy("offset").collect()
    assert [r.operation for r in got] == ["c", "u", "u", "r", "d", "t", "d", "c", "c", "u", "u"]
    assert {r.table_name for r in got} == {"orders"}
    assert got[5].payload is None and got[5].record_key == '{"order_id":2}'
    assert (got[0].year, got[0].month, got[0].day) == (2024, 1, 1)
    assert set(cdc.silver(feed(spark, CHANGES)).columns) == set(schemas.CDC_SILVER.names)


def test_current_state(spark):
    state = cdc.current_state(cdc.silver(feed(spark, CHANGES)), "orders", SCHEMA, ["order_id"])
    assert rows(state, "order_id", "order_status") == [(1, "shipped"), (3, "again"), (4, "second")]
    assert state.columns == SCHEMA.names


def test_history(spark):
    got = cdc.history(cdc.silver(feed(spark, CHANGES)), "orders", SCHEMA, ["order_id"], ["order_status"])
    seconds = [
        (r.order_id, r.order_status, (r.effective_from - T0).seconds,
         r.effective_to and (r.effective_to - T0).seconds, r.is_current)
        for r in got.orderBy("order_id", "effective_from").collect()
    ]
    assert seconds == [
        (1, "new", 0, 2, False), (1, "shipped", 2, None, True), (2, "new", 1, 4, False),
        (3, "old", 3, 5, False), (3, "again", 6, None, True), (4, "second", 7, None, True),
    ]


def test_other_tables_are_left_out(spark):
    assert cdc.changes(cdc.silver(feed(spark, CHANGES)), "products", SCHEMA).count() == 0
