"""Operators on data where one key, slot or group of copies holds most rows, by brute force."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.operators.intervals import trailing_counts
from basketry.operators.keys import assign_keys, last_key
from basketry.operators.ranking import first_per_key, latest_per_key
from basketry.operators.sessions import sessionize
from basketry.operators.skew import heavy_keys, skew_join
from basketry.operators.versions import as_of_lookup, merge_as_of, scd2
from basketry.plans import analytics
from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def facts(spark):
    rnd = random.Random(1)
    data = []
    for i in range(4000):
        key = "hot" if i % 3 else rnd.choice(["a", "b", "c", None, "x"])
        data.append((key, rnd.randrange(40 * 86400), rnd.randrange(3)))
    data += [("hot", 77, 1)] * 500
    return data


def test_skew_join_equals_plain_join(spark, facts):
    left = spark.createDataFrame(facts, "k string, t int, v int").repartition(4)
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3), ("lonely", 4)], "k string, name int")
    assert rows(heavy_keys(left, ["k"]).select("k").filter("k = 'hot'")) == [("hot",)]
    for how in ("inner", "left"):
        assert rows(skew_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))


def test_heavy_key_is_spread(spark, facts):
    from basketry.operators.skew import spread

    left = spark.createDataFrame(facts, "k string, t int, v int").repartition(4)
    parts = spread(left, heavy_keys(left, ["k"]), ["k"]).filter("k = 'hot'").groupBy("_part").count()
    sizes = [r["count"] for r in parts.collect()]
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_heavy_keys_are_few(spark):
    even = spark.range(5000).selectExpr("id as k")
    assert heavy_keys(even, ["k"]).count() == 0


def _scd2_brute(changes):
    """changes: (key, seconds, id, deleted, attribute)"""
    out = []
    by_key = {}
    for c in changes:
        by_key.setdefault(c[0], {}).setdefault(c[1], []).append(c)
    for key, instants in by_key.items():
        last, opened = None, None
        for t in sorted(instants):
            c = max(instants[t], key=lambda c: (c[2], c[3], c[4]))
            state = None if c[3] else c[4]
            if state == last and (state is not None or last is None):
                continue
            if last is not None:
                out.append((key, last, at(opened), at(t), False))
            last, opened = state, t
        if last is not None:
            out.append((key, last, at(opened), None, True))
    return sorted(out, key=str)


CHANGES = st.lists(
    st.tuples(st.sampled_from("hhhhab"), st.integers(0, 5).map(lambda i: i * 40000),
              st.integers(0, 3), st.booleans(), st.sampled_from("pq")),
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CHANGES)
def test_scd2_small(spark, changes):
    _check_scd2(spark, changes)


def test_scd2_hot_key(spark):
    rnd = random.Random(2)
    changes = [
        ("hot" if i % 4 else f"k{i % 50}", rnd.randrange(200) * 3600, rnd.randrange(9), rnd.random() < 0.2,
         rnd.choice("pqr"))
        for i in range(3000)
    ]
    _check_scd2(spark, changes + [("hot", 7200, 5, False, "p")] * 1000)


def _check_scd2(spark, changes):
    data = [(k, at(t), i, d, a) for k, t, i, d, a in changes]
    df = spark.createDataFrame(data, "k string, t timestamp, id int, is_deleted boolean, a string")
    got = scd2(df, ["k"], "t", ["a"], ["id"])
    assert rows(got, "k", "a", "effective_from", "effective_to", "is_current") == _scd2_brute(changes)


def test_merge_as_of(spark, facts):
    rnd = random.Random(3)
    versions = []
    for key in ("hot", "a", "b"):
        marks = sorted(rnd.sample(range(0, 40 * 86400, 3600), 30))
        for lo, hi in zip(marks, [*marks[1:], None]):
            if rnd.random() < 0.8:
                versions.append((key, f"{key}{lo}", lo, hi))
    boundary = [("hot", lo, 9) for k, _, lo, _ in versions if k == "hot"]
    data = facts + boundary
    left = spark.createDataFrame([(k, at(t), v) for k, t, v in data], "k string, t timestamp, v int")
    right = spark.createDataFrame(
        [(k, n, at(lo), None if hi is None else at(hi)) for k, n, lo, hi in versions],
        "k string, name string, _from timestamp, _to timestamp",
    )

    def valid(k, t):
        hits = [n for vk, n, lo, hi in versions if vk == k and lo <= t and (hi is None or t < hi)]
        assert len(hits) <= 1
        return hits[0] if hits else None

    want = sorted(((k, at(t), v, valid(k, t)) for k, t, v in data), key=str)
    assert rows(merge_as_of(left.repartition(4), right, ["k"], "t", ["name"])) == want


def test_sessions(spark, facts):
    data = [(k, at(t)) for k, t, _ in facts if k is not None]
    data += [("edge", at(0)), ("edge", at(1799)), ("edge", at(1799 + 1800)), ("edge", at(10**6))]
    df = spark.createDataFrame(data, "u string, t timestamp")
    want = []
    for user in {k for k, _ in data}:
        times = sorted(t for k, t in data if k == user)
        runs = [[times[0]]]
        for t in times[1:]:
            if (t - runs[-1][-1]).total_seconds() >= 1800:
                runs.append([])
            runs[-1].append(t)
        want += [(user, r[0], r[-1], len(r), len(r)) for r in runs]
    got = sessionize(df, "u", "t", 1800, {"n": F.lit(1)})
    assert rows(got, "u", "session_start", "session_end", "events", "n") == sorted(want, key=str)
    assert [r[3] for r in want if r[0] == "edge"] == [2, 1, 1]


def test_trailing_counts(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice("hhha"), rnd.randrange(5000), rnd.choice("cp")) for i in range(600)]
    data += [(900, "e", 0, "c"), (901, "e", 600, "p"), (902, "e", 601, "p")]
    df = spark.createDataFrame([(i, k, at(t), e) for i, k, t, e in data], "i int, k string, t timestamp, e string")
    got = trailing_counts(df, "k", "t", F.col("e") == "c", 600).filter("e = 'p'")
    want = []
    for i, k, t, e in data:
        if e == "p":
            hits = [t2 for _, k2, t2, e2 in data if k2 == k and e2 == "c" and t - 600 <= t2 <= t]
            want.append((i, len(hits), at(max(hits)) if hits else None))
    assert rows(got, "i", "trailing_count", "last_counted_at") == sorted(want, key=str)


def test_keys_are_unique_and_repeatable(spark):
    df = spark.range(3000).selectExpr("cast(id as string) k", "id v")
    first = rows(assign_keys(df.repartition(7), ["k"], "sk", hex_digits=1))
    keys = sorted(r[0] for r in first)
    assert len(set(keys)) == 3000 and keys[0] >= 1 and keys[-1] < 2 * 3000
    assert first == rows(assign_keys(df.coalesce(1), ["k"], "sk", hex_digits=1))
    held = assign_keys(df.filter("v < 10"), ["k"], "sk")
    more = assign_keys(df.filter("v >= 10"), ["k"], "sk", last_key(held, "sk"))
    assert len({r.sk for r in held.unionByName(more).collect()}) == 3000


def test_first_and_latest_row(spark):
    data = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q")] + [("a", 1, "y")] * 50
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(4)
    assert rows(first_per_key(df, ["k"], [F.col("t").asc_nulls_last()])) == [("a", 1, "y"), ("b", None, "q")]
    assert rows(latest_per_key(df, ["k"], ["t"])) == [("a", 2, "x"), ("b", None, "q")]


def test_as_of_lookup_agrees_either_way(spark, monkeypatch):
    from basketry.operators import versions

    dim = spark.createDataFrame(
        [("a", 1, at(0), at(10)), ("a", 2, at(10), None), ("b", 3, at(5), None)],
        "k string, sk int, effective_from timestamp, effective_to timestamp",
    )
    facts = spark.createDataFrame(
        [(k, at(t)) for k in ("a", "b", "c", None) for t in (0, 5, 9, 10, 99)], "k string, t timestamp"
    )
    small = versions.as_of_lookup(facts, dim, ["k"], "t", ["sk"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(versions, "FEW_VERSIONS", 1)
    merged = versions.as_of_lookup(facts, dim, ["k"], "t", ["sk"])
    assert "Union" in merged._jdf.queryExecution().executedPlan().toString()
    want = [("a", at(t), 1 if t < 10 else 2) for t in (0, 5, 9, 10, 99)]
    want += [("b", at(t), None if t < 5 else 3) for t in (0, 5, 9, 10, 99)]
    want += [(k, at(t), None) for k in ("c", None) for t in (0, 5, 9, 10, 99)]
    assert rows(small) == rows(merged) == sorted(want, key=str)


def test_trailing_counts_match_brute_force_and_need_no_sliding_frame(spark):
    at = [0, 0, 1, 599, 600, 601, 1200, 1201, 1300, 1800, 1900]
    events = [("u", T0 + dt.timedelta(seconds=t), "c" if i % 2 else "p") for i, t in enumerate(at)]
    df = spark.createDataFrame([*events, (None, events[0][1], "p"), (None, events[0][1], "c")], "k string, t timestamp, e string")
    out = trailing_counts(df, "k", "t", F.col("e") == "c", 600)
    got = sorted((r.t, r.e, r.trailing_count, r.last_counted_at) for r in out.collect() if r.k)
    want = []
    for _, t, e in events:
        near = [s for _, s, f in events if f == "c" and t - dt.timedelta(seconds=600) <= s <= t]
        want.append((t, e, len(near), max(near, default=None)))
    key = lambda r: (r[0], r[1], r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {(r.trailing_count, r.last_counted_at) for r in out.collect() if r.k is None} == {(0, None)}
    assert "preceding" not in out._jdf.queryExecution().optimizedPlan().toString().lower().replace("unboundedpreceding", "")


def test_unknown_users_have_no_session(spark):
    t = T0
    df = spark.createDataFrame([("u", t), (None, t), (None, t)], "u string, t timestamp")
    assert [r.u for r in sessionize(df, "u", "t", 1800, {"n": F.lit(1)}).collect()] == ["u"]


def test_as_of_paths_agree_on_null_keys_and_starts(spark):
    t = T0
    facts = spark.createDataFrame([("a", t), (None, t)], "k string, t timestamp")
    dim = spark.createDataFrame(
        [("a", 1, t, None), (None, 2, t, None), ("a", 3, None, None)],
        "k string, v int, effective_from timestamp, effective_to timestamp",
    )
    for versions in (1, 1000):
        got = as_of_lookup(facts, dim, ["k"], "t", ["v"], versions_per_key=versions).collect()
        assert {(r.k, r.v) for r in got} == {("a", 1), (None, None)}


def test_redelivered_orders_and_payments_count_once(spark):
    t = T0
    orders = spark.createDataFrame([("o", "u", t, 10.0)] * 2 + [(None, "u", t, 5.0)], "order_id string, user_id string, event_time timestamp, total_amount double")
    pays = spark.createDataFrame([("p", "o", t, "success", 10.0)] * 2, "payment_id string, order_id string, event_time timestamp, status string, amount double")
    got = analytics.order_payments(orders, pays).collect()
    assert [(r.order_id, r.attempts, float(r.paid_amount)) for r in got] == [("o", 1, 10.0)]


def test_a_key_of_many_versions_and_a_burst_is_cut_evenly(spark):
    """Slots hold about equally many rows, no version is repeated, and each slot gets one row more."""
    from basketry.operators import versions

    second = lambda s: T0 + dt.timedelta(seconds=s)
    # Most versions of the key lie in a short burst, and so do most facts, many at one instant.
    marks = list(range(0, 3000)) + [10**6 + 1000 * i for i in range(40)]
    known = [("hot", i, second(s), second(t) if t is not None else None) for i, (s, t) in enumerate(zip(marks, [*marks[1:], None]))]
    at = [s + 0.5 for s in range(0, 3000, 2)] + [1500] * 4000 + [10**6 + 500 * i for i in range(80)]
    facts = [("hot", second(s), i) for i, s in enumerate(at)] + [("cold", second(5), -1), (None, second(5), -2), ("hot", None, -3)]
    left = spark.createDataFrame(facts, "k string, t timestamp, n int").repartition(4)
    right = spark.createDataFrame(known, "k string, v int, _from timestamp, _to timestamp")
    got = {r.n: r.v for r in versions.merge_as_of(left, right, ["k"], "t", ["v"]).collect()}
    starts = [second(m) for m in marks]

    def valid(t):
        return None if t is None else max((i for i, s in enumerate(starts) if s <= t), default=None)

    assert got == {n: valid(t) if k == "hot" else None for k, t, n in facts}
    times = left.select("k", F.col("t").alias("_at")).unionByName(right.select("k", F.col("_from").alias("_at")))
    bounds = versions._quantiles(times, ["k"])
    one = left.withColumn("_fact", F.struct("*")).select("k", F.col("t").alias("_at"), F.lit(1).alias("_kind"), "_fact")
    two = right.select("k", F.col("_from").alias("_at"), F.lit(0).alias("_kind"), F.struct("v", "_to").alias("_version"))
    slots = [versions._slotted(rows_, bounds, ["k"]) for rows_ in (one, two)]
    assert slots[1].count() == len(known)
    sizes = slots[0].select("_slot").union(slots[1].select("_slot")).groupBy("_slot").count().collect()
    total = sum(r["count"] for r in sizes)
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) <= 2.5 * total / len(sizes)
    assert versions._carried(slots[1], bounds, ["k"]).count() < bounds.select(F.explode("_bounds")).count() + 1


def test_versions_without_heavy_keys_read_the_changes_once(spark):
    from basketry.operators.skew import heavy_buckets

    even = spark.range(4000).selectExpr(
        "id % 1000 as k", "timestamp_seconds(id * 60) as t", "id", "false as is_deleted", "id % 7 as a"
    )
    assert heavy_buckets(even, ["k"], "t") is None
    plan = scd2(even, ["k"], "t", ["a"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1 and "Join" not in plan
    hot = even.withColumn("k", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("k")))
    found = heavy_buckets(hot, ["k"], "t").collect()
    assert len(found) == 1 and found[0]["_parts"] == 3 and found[0]["_lo"] == 60_000_000
