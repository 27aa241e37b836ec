"""Funnels against a fold of each user's events, and sessions and unpaid orders of streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.config import Settings
from basketry.operators.funnel import funnel_steps, step_progress
from basketry.operators.sessions import sessionize
from basketry.session import streaming_session
from basketry.streaming.joins import orders_with_payments
from basketry.streaming.sessions import session_stream, with_open_sessions
from conftest import rows

START = dt.datetime(2024, 1, 1)
STEPS = ("a", "b", "c", "d")


def fold(events, seconds):
    """User to the furthest step, by following the beginning of the newest chain at each step."""
    out = {}
    users = {u for u, *_ in events if u is not None}
    for user in users:
        mine = sorted(((t, STEPS.index(k)) for u, t, k in events if u == user and t is not None and k in STEPS))
        begun, best = {}, -1
        for t, step in mine:
            if step == 0:
                begun[0] = t
            elif step - 1 in begun and t - begun[step - 1] <= dt.timedelta(seconds=seconds):
                begun[step] = max(begun.get(step, t - dt.timedelta(days=9999)), begun[step - 1])
            else:
                continue
            best = max(best, step)
        if best >= 0:
            out[user] = best
    return out


@pytest.mark.parametrize("seed", range(3))
def test_funnel_equals_a_fold(spark, seed):
    rnd = random.Random(seed)
    events = [
        (rnd.choice(["u1", "u2", "u3", "busy", "busy", "busy", None]), START + dt.timedelta(seconds=rnd.randrange(3000)),
         rnd.choice([*STEPS, "other"]))
        for _ in range(400)
    ] + [("u1", None, "a"), ("u4", START, "d"), ("u5", START, "a"), ("u5", START, "b"), ("u6", START, "a"),
         ("u6", START + dt.timedelta(seconds=60), "b"), ("u7", START, "a"), ("u7", START + dt.timedelta(seconds=61), "b")]
    df = spark.createDataFrame(events, "user string, at timestamp, kind string")
    steps = {s: F.col("kind") == s for s in STEPS}
    want = fold(events, 60)
    got = step_progress(df, "user", "at", list(steps.values()), 60).groupBy("_user").agg(F.max("step").alias("s"))
    assert dict(rows(got, "_user", "s")) == {u: s + 1 for u, s in want.items()}
    table = funnel_steps(df, "user", "at", steps, 60).orderBy("step").collect()
    counts = [sum(s >= i for s in want.values()) for i in range(4)]
    assert [r.users for r in table] == counts
    assert table[0].from_previous_pct is None and table[0].from_first_pct == 100.0
    assert table[1].from_previous_pct == round(100 * counts[1] / counts[0], 2)


def test_funnel_of_nothing(spark):
    df = spark.createDataFrame([], "user string, at timestamp, kind string")
    got = funnel_steps(df, "user", "at", {s: F.col("kind") == s for s in STEPS}, 60)
    assert rows(got, "step", "users", "from_first_pct") == [(i, 0, None) for i in range(1, 5)]


SETTINGS = Settings(watermark="10 minutes", state_partitions=2)


def drained(spark, frame, tmp_path, name):
    writer = frame.writeStream.format("parquet").option("path", f"{tmp_path}/{name}")
    writer.option("checkpointLocation", f"{tmp_path}/{name}_cp").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")


def source(spark, tmp_path, name, data, schema, files):
    for part in files:
        spark.createDataFrame([data[i] for i in part], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    session = streaming_session(spark, SETTINGS)
    return session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")


def minute(m, s=0):
    return START + dt.timedelta(minutes=m, seconds=s)


def test_unpaid_orders_come_when_their_time_has_passed(spark, tmp_path):
    orders = [("o1", "u", 1.0, minute(0)), ("o2", "u", 2.0, minute(1)), ("o3", "u", 3.0, minute(2)), ("o9", "u", 9.0, minute(90))]
    paid = [("p1", "o1", "success", 1.0, minute(3)), ("p2", "o2", "success", 2.0, minute(12)), ("p9", "o9", "success", 9.0, minute(91))]
    o = source(spark, tmp_path, "o", orders, "order_id string, user_id string, total_amount double, event_time timestamp", [[0, 1], [2], [3]])
    p = source(spark, tmp_path, "p", paid, "payment_id string, order_id string, status string, amount double, event_time timestamp", [[0, 1], [2]])
    got = drained(spark, orders_with_payments(o, p, 10, SETTINGS, unpaid=True), tmp_path, "out")
    # The payment of o2 is eleven minutes late, o3 has none.
    assert rows(got, "order_id", "payment_id") == [("o1", "p1"), ("o2", None), ("o3", None), ("o9", "p9")]


def test_sessions_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    rnd = random.Random(3)
    data = [(rnd.choice(["u1", "u2", "u3", None]), minute(k * 5 + rnd.randrange(5)), rnd.randrange(9)) for k in range(120)]
    data += [("gap", minute(0), 1), ("gap", minute(30), 1), ("gap", minute(59, 59), 1)]
    data.sort(key=lambda r: r[1])
    cuts = [0, 30, 31, 80, len(data)]
    schema = "user string, at timestamp, v int"
    stream = source(spark, tmp_path, "e", data, schema, [range(a, b) for a, b in zip(cuts, cuts[1:])])
    measures = {"total": F.col("v")}
    closed = drained(spark, session_stream(stream, "user", "at", measures, SETTINGS), tmp_path, "s")
    table = spark.createDataFrame(data, schema)
    want = sessionize(table, "user", "at", 1800, measures)
    assert 0 < closed.count() < want.count()
    got = with_open_sessions(closed, table, "user", "at", measures, SETTINGS)
    columns = ["user", "session_start", "session_end", "events", "total"]
    assert rows(got, *columns) == rows(want, *columns)
