import datetime as dt

from basketry import schemas
from basketry.functions.dates import between_days
from basketry.functions.parse import dead_letters, of_type, parse_events
from basketry.plans import kpi
from conftest import rows

TEXTS = [
    '{"event_type":"order_placed","order_id":"a","quantity":2,"total_amount":9.5,"timestamp":"2024-01-01T00:00:30.5+00:00"}',
    '{"event_type":"order_placed","order_id":"b","quantity":1,"total_amount":1.0,"extra":7,"timestamp":"2024-01-01T01:00:10+01:00"}',
    '{"event_type":"order_placed","order_id":"c","quantity":"many","timestamp":"2024-01-01T00:00:40Z"}',
    '{"event_type":"order_returned","return_id":"r","order_id":"a","refund_amount":3.5,"reason":"defective","timestamp":"2024-01-01T00:00:59Z"}',
    '{"event_type":"order_placed","order_id":"d","timestamp":"garbage"}',
    '{"event_type":"order_placed","order_id":"e"}',
    '{"event_type":"order_pl',
    None,
]


def records(spark, texts=TEXTS, topic="orders"):
    data = [(None, t and t.encode(), topic, 0, i, None, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, schemas.KAFKA)


def test_good_rows_are_typed(spark):
    parsed = parse_events(records(spark), schemas.ORDERS_TOPIC)
    assert rows(parsed, "order_id", "quantity", "year", "month", "day") == [
        ("a", 2, 2024, 1, 1), ("a", None, 2024, 1, 1), ("b", 1, 2024, 1, 1), ("c", None, 2024, 1, 1),
    ]
    assert parsed.schema.names == schemas.bronze("orders").names
    first = parsed.filter("offset = 0").first()
    assert first.event_time == dt.datetime(2024, 1, 1, 0, 0, 30, 500000)
    assert first.value == TEXTS[0]


def test_bad_rows_are_kept_apart(spark):
    assert rows(dead_letters(records(spark), schemas.ORDERS_TOPIC), "offset", "reason") == [
        (4, "bad timestamp"), (5, "no timestamp"), (6, "no timestamp"), (7, "empty"),
    ]


def test_returns_do_not_count_as_orders(spark):
    parsed = parse_events(records(spark), schemas.ORDERS_TOPIC)
    assert kpi.revenue_per_minute(of_type(parsed, "order_placed")).first().order_count == 3
    net = kpi.net_revenue(parsed).first()
    assert (float(net.gross_revenue), float(net.refunds), float(net.net_revenue)) == (10.5, 3.5, 7.0)
    reason = kpi.returns_by_reason(of_type(parsed, "order_returned")).first()
    assert (reason.reason, reason.return_count) == ("defective", 1)


def test_text_is_parsed_once(spark):
    plan = parse_events(records(spark), schemas.ORDERS_TOPIC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_between_days_is_inclusive(spark):
    days = [(dt.date(2023, 12, 30) + dt.timedelta(days=i),) for i in range(6)]
    df = spark.createDataFrame(days, "d date").selectExpr("d", "year(d) year", "month(d) month", "day(d) day")
    picked = df.filter(between_days(dt.date(2023, 12, 31), dt.date(2024, 1, 2)))
    assert [r.d.day for r in picked.orderBy("d").collect()] == [31, 1, 2]


def test_top_products_order_ties_by_id(spark):
    data = [("2024-01-01", p, "n", 1, 5) for p in "gfedcba"]
    df = spark.createDataFrame(data, "window_start string, product_id string, product_name string, units_sold int, revenue int")
    got = kpi.top_products(df).orderBy("rank_position").collect()
    assert [(r.product_id, r.rank_position) for r in got] == [(p, i + 1) for i, p in enumerate("abcde")]


def test_empty_metrics(spark):
    empty = spark.createDataFrame([], schemas.bronze("orders"))
    assert kpi.revenue_per_minute(empty).count() == 0
    assert kpi.top_products(kpi.product_metrics(empty)).count() == 0
