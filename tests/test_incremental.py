"""Runs over the last days against runs over everything, and what they read."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from basketry import jobs, schemas
from basketry.config import Settings
from basketry.functions.parse import parse_events
from basketry.operators.sessions import carry, session_states, sessionize
from basketry.plans import gold
from conftest import rows

TABLES = ("daily_revenue", "product_performance", "session_analytics", "product_days", "product_buyers", "session_carry")


def order(i, at, user, product):
    return {"event_type": "order_placed", "order_id": f"o{i}", "user_id": user, "product_id": product, "product_name": product,
            "category": None, "quantity": 1 + i % 3, "total_amount": 1.25 + i, "country": "DE", "order_status": "new",
            "timestamp": at.isoformat() + "+00:00"}


def visit(i, at, user):
    return {"event_type": "user_activity", "activity_id": f"a{i}", "user_id": user, "activity_type": "login",
            "timestamp": at.isoformat() + "+00:00"}


def store(spark, settings, topic, made, offset):
    data = [(None, json.dumps(e).encode(), topic, 0, offset + i, None, 0) for i, e in enumerate(made)]
    parsed = parse_events(spark.createDataFrame(data, schemas.KAFKA), schemas.TOPIC_SCHEMAS[topic])
    parsed.write.partitionBy("year", "month", "day").mode("append").parquet(settings.bronze(topic))


def stored(spark, settings):
    out = {}
    for name in TABLES:
        df = spark.read.parquet(settings.gold(name))
        out[name] = rows(df, *sorted(df.columns))
    return out


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """A lake brought up to date day by day, and the same built at once."""
    rnd = random.Random(2)
    root = tmp_path_factory.mktemp("days")
    step, whole = (Settings(lake_root=f"{root}/{n}") for n in ("step", "whole"))
    start, n = dt.datetime(2024, 5, 1), 0
    everything = {"orders": [], "users": []}
    for day in range(4):
        made = {"orders": [], "users": []}
        for _ in range(60):
            # Most of the traffic lies around midnight, so that sessions go on over it.
            minute = rnd.choice([rnd.randrange(60), 1440 - 1 - rnd.randrange(60), rnd.randrange(1440)])
            at = start + dt.timedelta(days=day, minutes=minute, seconds=rnd.randrange(60))
            user = rnd.choice(["u1", "u2", "u3", None])
            if rnd.random() < 0.4:
                made["orders"].append(order(n if rnd.random() < 0.9 else max(n - 30, 0), at, user, f"p{rnd.randrange(4)}"))
            else:
                made["users"].append(visit(n, at, user))
            n += 1
        made["users"] += [visit(10_000 + day * 100 + i, start + dt.timedelta(days=day, minutes=20 * i), "always") for i in range(72)]
        for topic, events in made.items():
            store(spark, step, topic, events, day * 1000)
            everything[topic] += events
        jobs.build_gold(spark, step, None if day == 0 else (start + dt.timedelta(days=day)).date())
    # A late event of the day before: the run goes back to that day.
    late = [visit(9000, start + dt.timedelta(days=2, minutes=1439), "u1")]
    store(spark, step, "users", late, 9000)
    everything["users"] += late
    jobs.build_gold(spark, step, dt.date(2024, 5, 3))
    for topic, events in everything.items():
        store(spark, whole, topic, events, 0)
    jobs.build_gold(spark, whole)
    return step, whole


def test_daily_runs_equal_one_run(spark, runs):
    step, whole = (stored(spark, s) for s in runs)
    for name in TABLES:
        assert step[name] == whole[name], name


def test_tables_that_add_up_equal_the_plain_ones(spark, runs):
    _, whole = runs
    clean = gold.tidy_orders(jobs.silver_orders(spark, whole))
    want = gold.product_performance(clean)
    got = spark.read.parquet(whole.gold("product_performance"))
    assert rows(got, *want.columns) == rows(want)
    activity = spark.read.schema(schemas.bronze("users")).parquet(whole.bronze("users"))
    sessions = gold.session_analytics(gold.session_events(activity, clean))
    got = spark.read.parquet(whole.gold("session_analytics"))
    assert rows(got, *sessions.columns) == rows(sessions)
    assert any(r.session_start.date() < r.session_day for r in got.collect())


def test_untouched_days_are_not_read(spark, runs, monkeypatch):
    """Of silver orders and of the activity, each written table reads the days from the first one
    on (sessions one day more)."""
    step, _ = runs
    read, real = {}, jobs.replace_since

    def filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line.split("PartitionFilters: ")[1] for line in plan.split("\n") if "silver/orders" in line or "bronze/users" in line]

    def watched(df, path, *more):
        read[path.split("/")[-1]] = filters(df)
        real(df, path, *more)

    states = jobs.session_states

    def seen(*arguments):
        out = states(*arguments)
        read["sessions"] = filters(out)
        return out

    monkeypatch.setattr(jobs, "replace_since", watched)
    monkeypatch.setattr(jobs, "session_states", seen)
    before = stored(spark, step)
    jobs.build_gold(spark, step, dt.date(2024, 5, 4))
    assert stored(spark, step) == before
    for name in ("daily_revenue", "product_buyers", "product_days"):
        assert read[name] and all(">= 2024-05-04" in f for f in read[name]), name
    assert len(read["sessions"]) == 2
    assert any(">= 2024-05-03" in f for f in read["sessions"]) and all("isnotnull" in f for f in read["sessions"])


def test_states_of_sessions_over_days(spark):
    at = lambda d, h, m=0: dt.datetime(2024, 5, d, h, m)
    data = [("u", at(1, 23, 50), 1), ("u", at(2, 0, 10), 2), ("u", at(2, 3), 4), ("u", at(2, 23, 59), 8), ("v", at(1, 23, 40), 1)]
    df = spark.createDataFrame(data, "user string, at timestamp, n int")
    measures = {"n": F.col("n")}
    states = session_states(df, None, "user", "at", 1800, measures)
    got = rows(states.select("user", "session_start", "events", "n", F.dayofmonth("day").alias("d"), "ended"))
    assert got == sorted([
        ("u", at(1, 23, 50), 1, 1, 1, False), ("u", at(1, 23, 50), 2, 3, 2, True), ("u", at(2, 3), 1, 4, 2, True),
        ("u", at(2, 23, 59), 1, 8, 2, True), ("v", at(1, 23, 40), 1, 1, 1, True)], key=str)
    open_ones = carry(states, 1800)
    assert rows(open_ones, "user", F.dayofmonth("day").alias("d")) == [("u", 1), ("u", 2), ("v", 1)]
    second = session_states(
        df.filter(F.dayofmonth("at") == 2), open_ones.filter(F.dayofmonth("day") == 1), "user", "at", 1800, measures
    )
    late = second.filter("ended and dayofmonth(day) = 2").select("user", "session_start", "session_end", "events", "n")
    want = sessionize(df, "user", "at", 1800, measures).filter("dayofmonth(session_end) = 2")
    assert rows(late) == rows(want, *late.columns)
    with pytest.raises(ValueError):
        session_states(df, None, "user", "at", 86400, measures)


def test_repeats_are_looked_up_in_the_index(spark, runs, monkeypatch):
    """The same rows as an anti join with all earlier ids, and of silver only days with a hit are read."""
    step, _ = runs
    first = dt.date(2024, 5, 4)
    earlier = jobs.silver_orders(spark, step).filter(F.col("order_date") < first)
    again = earlier.filter(F.col("order_date") == dt.date(2024, 5, 2)).limit(3)
    new = jobs.silver_orders(spark, step).filter(F.col("order_date") >= first)
    mixed = new.unionByName(again)
    want = rows(jobs._without(mixed, earlier, "order_id"), "order_id")
    got = jobs.without_repeats(spark, step, mixed, first)
    assert rows(got, "order_id") == want and len(want) == new.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1] for line in plan.split("\n") if "silver/orders" in line and "PartitionFilters" in line]
    assert any("2024-05-02" in f or "19845" in f for f in filters)
    alone = jobs.without_repeats(spark, step, new, first)
    assert rows(alone, "order_id") == rows(new, "order_id")
