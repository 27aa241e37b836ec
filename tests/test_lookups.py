"""Lookups in dimensions that are too large to broadcast."""

from basketry.operators import skew, versions
from basketry.plans import analytics


def test_a_dimension_of_one_version_per_key_is_joined_without_sorting_by_time(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    dim = spark.sql(
        "select id as k, id * 10 as v, timestamp '2024-01-01' as effective_from, "
        "if(id = 3, timestamp '2024-02-01', null) as effective_to from range(5)"
    )
    fact = spark.sql("select if(id = 9, null, id % 6) as k, id as n, timestamp '2024-03-01' as at from range(10)")
    out = versions.as_of_lookup(fact, dim, ["k"], "at", ["v"], counted=fact, versions_per_key=1)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    merged = versions.as_of_lookup(fact, dim, ["k"], "at", ["v"], counted=fact)
    got = sorted((r.n, r.v) for r in out.collect())
    assert got == sorted((r.n, r.v) for r in merged.collect())
    assert got == [(n, None if n in (3, 5, 9) else n % 6 * 10) for n in range(10)]


def test_facts_are_summed_up_before_the_buyer_is_looked_up(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    fact = spark.sql(
        "select cast(id % 3 as bigint) as user_key, if(id % 2 = 0, null, 'X') as shipping_country, "
        "cast(1.5 as decimal(14,2)) as total_amount from range(12)"
    )
    users = spark.sql("select id as user_key, concat('H', id) as country from range(2)")
    out = analytics.revenue_by_country(fact, users)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_parts" not in plan  # facts are neither counted by key nor spread
    assert {(r.country, float(r.total_revenue), r.order_count) for r in out.collect()} == {
        ("X", 9.0, 6), ("H0", 3.0, 2), ("H1", 3.0, 2), (None, 3.0, 2)}


def test_slots_come_from_the_stored_times_alone(spark, monkeypatch):
    """The versions and facts are each read once, and a heavy key is still cut into slots."""
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 0)
    day = "timestamp_seconds(1704067200 + id * 60)"
    stored = spark.sql(f"select if(id % 9 = 0, id, 1) as k, {day} as at, id as n from range(900)")
    fact = stored.filter("n % 2 = 1")
    until = "if(id < 1800, timestamp_seconds(1704067200 + (id + 3) * 60), null)"
    dim = spark.sql(f"select 1L as k, id as v, {day} as effective_from, {until} as effective_to from range(0, 900, 3)")
    counted = versions.as_of_lookup(fact, dim, ["k"], "at", ["v"])
    known = versions.as_of_lookup(fact, dim, ["k"], "at", ["v"], times=stored)
    got = sorted((r.k, r.n, r.v) for r in known.collect())
    assert got == sorted((r.k, r.n, r.v) for r in counted.collect())
    assert got == sorted((k, n, n // 3 * 3 if k == 1 else None) for k, n in
                         ((n if n % 9 == 0 else 1, n) for n in range(1, 900, 2)))
    scans = [f._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 900, step=3") for f in (counted, known)]
    assert scans[1] < scans[0]
