"""Every registered query against its SQL in DuckDB, on the whole test tables."""

import math

import duckdb
import pytest

import __spark_entry__
import oracles
import testqueries

QUERIES = testqueries.QUERIES
ORACLES = oracles.oracle_sql()
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


def _sorted(rows):
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=str)


def test_only_approximate_counts_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == {"kpi_active_users_approx", "kpi_active_users_approx_stream"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    result = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in result.description}
    names = list(types)
    expected = result.fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    got = _sorted(tuple(r) for r in df.select(*columns).collect())
    assert got == _sorted([r[i] for i in order] for r in expected)


@pytest.mark.parametrize("suffix", ["", "_stream"])
def test_approximate_users_are_close(spark, sf, duck, suffix):
    exact = dict(duck.execute(
        "SELECT date_trunc('minute', ts), COUNT(DISTINCT user_id) FROM events GROUP BY 1").fetchall())
    got = {r.window_start: r.active_user_count for r in
           QUERIES["kpi_active_users_approx" + suffix](spark, sf).collect()}
    assert got.keys() == exact.keys()
    assert all(abs(got[w] - n) <= 0.15 * n + 0.5 for w, n in exact.items())


def test_entry_runs(spark, sf):
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_lists_all_queries():
    """With the training-data operators if they are there, and without them if not."""
    names = set(__spark_entry__.queries())
    assert set(QUERIES) <= names and set(__spark_entry__.oracle_sql()) <= names
    assert (names > set(QUERIES)) == (__spark_entry__.llm is not None)
