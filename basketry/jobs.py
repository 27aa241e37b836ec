"""The batch jobs over the lake: bronze to gold, gold to warehouse, metrics to daily summary.

The streaming application is basketry.streaming.app.start_all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType, TimestampType

from basketry import schemas
from basketry.config import Settings
from basketry.functions.dates import between_days, seconds_of
from basketry.functions.parse import of_type
from basketry.operators.sessions import carry, session_states
from basketry.plans import gold, kpi, serving, warehouse
from basketry.session import scratch_path
from basketry.sources.catalog import refresh_statistics, register_dataset
from basketry.sources.files import delete_folder, ensure_folder, folder_names, read_dataset
from basketry.streaming import app, upsert_log
from basketry.streaming.bronze import DATE_PARTS
from basketry.streaming.tables import replace_since, replace_table, write_ranked

LAST_DAY = dt.date(9998, 12, 31)
SILVER_ORDERS = StructType(
    [
        *schemas.TOPIC_SCHEMAS["orders"].fields,
        StructField("event_time", TimestampType()), StructField("order_date", DateType()),
    ]
)


def bronze_orders(spark: SparkSession, settings: Settings, first_day: dt.date | None = None) -> DataFrame:
    rows = read_dataset(spark, settings.bronze("orders"), schemas.bronze("orders"))
    if first_day is not None:
        rows = rows.filter(between_days(first_day, LAST_DAY))
    return of_type(rows, "order_placed")


def build_silver(spark: SparkSession, settings: Settings, first_day: dt.date | None = None) -> None:
    """Write the earliest copy of each order once, by day; with first_day, only the days from then on.

    An order that silver has under an earlier day is a repeat, however late it comes. An order
    without a usable amount is kept here, so that a later copy cannot take its place.
    """
    orders = gold.dedup_orders(bronze_orders(spark, settings, first_day))
    orders = orders.withColumn("order_date", F.to_date("event_time")).select(*SILVER_ORDERS.fieldNames())
    staged = None
    if first_day is not None:
        staged = scratch_path(spark, "orders")
        orders.write.parquet(staged)
        orders = without_repeats(spark, settings, spark.read.schema(SILVER_ORDERS).parquet(staged), first_day)
    replace_since(orders, settings.silver("orders"), "order_date", first_day, scratch_path(spark, "silver"))
    fresh = silver_orders(spark, settings)
    if first_day is not None:
        fresh = fresh.filter(F.col("order_date") >= first_day)
    replace_since(_hashes(fresh), settings.silver("order_index"), "order_date", first_day, scratch_path(spark, "index"), ["h"])
    if staged is not None:
        delete_folder(spark, staged)


def _hashes(orders: DataFrame) -> DataFrame:
    """The index of order ids: a number of eight bytes for each, by day."""
    return orders.select("order_date", F.xxhash64("order_id").alias("h"))


def without_repeats(spark: SparkSession, settings: Settings, orders: DataFrame, first_day: dt.date) -> DataFrame:
    """The orders that silver does not have under an earlier day.

    Earlier days are looked up in the index, which holds a hash of each id. Only the days in which a
    hash is found are read from silver, and only their rows with such a hash are compared by id.
    `orders` is a stored table with one row per id.
    """
    path = settings.silver("order_index")
    earlier = F.col("order_date") < first_day
    silver = silver_orders(spark, settings).filter(earlier)
    index = _hashes(silver)
    if folder_names(spark, path):
        index = read_dataset(spark, path, index.schema).filter(earlier)
    recent = _hashes(orders).select("h")
    found = scratch_path(spark, "repeats")
    index.join(recent, "h", "left_semi").distinct().write.parquet(found)
    hits = spark.read.schema(index.schema).parquet(found)
    days = [r.order_date for r in hits.select("order_date").distinct().collect()]  # at most one a day
    if not days:
        return orders
    known = silver.filter(F.col("order_date").isin(days)).withColumn("h", F.xxhash64("order_id"))
    return _without(orders, known.join(hits, ["order_date", "h"], "left_semi"), "order_id")


def silver_orders(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_dataset(spark, settings.silver("orders"), SILVER_ORDERS)


def _without(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The rows whose key, null or not, is not among the known ones. Both sides have a key once."""
    known = known.select(F.col(key).alias("_seen"))
    return rows.join(known, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")


def build_gold(spark: SparkSession, settings: Settings, first_day: dt.date | None = None) -> None:
    """Bring silver orders and all gold tables up to date.

    With first_day, only days from then on are read from bronze and silver. What reaches over days
    is kept in a form that adds up: sums of a product by day, its buyers by the day of their first
    order, and the sessions that are open at midnight.
    """
    build_silver(spark, settings, first_day)
    clean = gold.tidy_orders(silver_orders(spark, settings))
    recent = clean if first_day is None else clean.filter(F.col("order_date") >= first_day)
    replace_since(
        gold.daily_revenue(recent), settings.gold("daily_revenue"), "order_date", first_day, scratch_path(spark, "gold")
    )
    _build_products(spark, settings, recent, first_day)
    _build_sessions(spark, settings, clean, first_day)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return read_dataset(spark, path, like.schema)


def _build_products(spark: SparkSession, settings: Settings, recent: DataFrame, first_day: dt.date | None) -> None:
    buyers_path, days_path = settings.gold("product_buyers"), settings.gold("product_days")
    buyers = gold.first_buyers(recent)
    if first_day is not None:
        known = _stored(spark, buyers_path, buyers).filter(F.col("first_day") < first_day)
        buyers = gold.first_buyers(recent, known)
    replace_since(buyers, buyers_path, "first_day", first_day, scratch_path(spark, "gold"))
    buyers = _stored(spark, buyers_path, buyers)
    if first_day is not None:
        buyers = buyers.filter(F.col("first_day") >= first_day)
    days = gold.product_days(recent, buyers)
    replace_since(days, days_path, "order_date", first_day, scratch_path(spark, "gold"))
    totals = gold.product_totals(_stored(spark, days_path, days))
    write_ranked(totals, settings.gold("product_performance"), "total_revenue", scratch_path(spark, "gold"))


def _build_sessions(spark: SparkSession, settings: Settings, clean: DataFrame, first_day: dt.date | None) -> None:
    """Sessions by the day of their last event. The day before first_day is worked out again, from
    the sessions open at its first instant, as sessions that ended there may now go on."""
    gap = seconds_of(settings.session_gap)
    activity = read_dataset(spark, settings.bronze("users"), schemas.bronze("users"))
    day = None if first_day is None else first_day - dt.timedelta(days=1)
    if day is not None:
        activity = activity.filter(between_days(day, LAST_DAY))
        clean = clean.filter(F.col("order_date") >= day)
    events = gold.session_events(activity, clean)
    measures, path = gold.session_measures(), settings.gold("session_carry")
    states = session_states(events, None, "user_id", "event_time", gap, measures)
    if day is not None:
        carried = _stored(spark, path, states).filter(F.col("day") == day - dt.timedelta(days=1))
        states = session_states(events, carried, "user_id", "event_time", gap, measures)
        states = states.filter(F.col("day") >= day)
    # Written once; sessions and what is open at midnight both come from it.
    staged = scratch_path(spark, "sessions")
    states.write.parquet(staged)
    stored = spark.read.schema(states.schema).parquet(staged)
    sessions = stored.filter("ended").drop("ended").withColumnRenamed("day", "session_day")
    replace_since(sessions, settings.gold("session_analytics"), "session_day", day, scratch_path(spark, "gold"))
    replace_since(carry(stored, gap), path, "day", day, scratch_path(spark, "gold"))
    delete_folder(spark, staged)


def load_warehouse(
    spark: SparkSession, settings: Settings, holidays: DataFrame | None = None, first_day: dt.date | None = None
) -> None:
    """Load the star schema from silver and gold, which build_gold has written.

    Rows that the stored tables know keep their keys. With first_day, only facts from then on
    are loaded; those before it need no rewrite, as the versions they name keep their keys.
    Dimension tables are written before facts look them up.
    """
    clean = gold.tidy_orders(silver_orders(spark, settings))
    payments = read_dataset(spark, settings.bronze("payments"), schemas.bronze("payments"))

    def store(name: str, df: DataFrame) -> DataFrame:
        replace_table(warehouse.as_table(df, _TABLES[name]), table_path(settings, name), scratch_path(spark, name))
        return read_table(spark, settings, name)

    def dimension(name: str, versions: DataFrame, natural: str, key: str) -> DataFrame:
        known = read_table(spark, settings, name)
        return store(name, warehouse.build_dimension(versions, [natural, "effective_from"], key, known))

    store("dim_date", warehouse.dim_date(clean, "event_time", holidays))
    users = dimension("dim_users", warehouse.user_versions(clean), "user_id", "user_key")
    products = dimension("dim_products", warehouse.product_versions(clean), "product_id", "product_key")

    if first_day is not None:
        clean = clean.filter(F.col("order_date") >= first_day)
        payments = payments.filter(between_days(first_day, LAST_DAY))
    # The stored tables have the keys in the shares of the facts.
    keyed = warehouse.with_dimension_keys(
        clean, warehouse.Dimension(users, counted=clean), warehouse.Dimension(products, counted=clean)
    )
    _store_fact(spark, settings, "fact_orders", warehouse.fact_orders(keyed), "order", first_day)

    paid = gold.first_payments(payments)
    if first_day is not None:
        stored = read_table(spark, settings, "fact_payments")
        paid = _without(paid, stored.filter(F.col("date_key") < _day_number(first_day)), "payment_id")
    paid = warehouse.with_dimension_keys(paid, warehouse.Dimension(users, counted=payments), None)
    _store_fact(spark, settings, "fact_payments", warehouse.fact_payments(paid), "payment", first_day)

    daily = read_dataset(spark, settings.gold("daily_revenue"), schemas.GOLD_DAILY_REVENUE)
    store("stg_daily_revenue", warehouse.stage_daily_revenue(daily))


AGGREGATES = schemas.select(
    schemas.FACT_ORDERS, "order_id", "date_key", "order_status", "quantity", "unit_price", "total_amount",
    "shipping_country", "order_timestamp",
)


def load_aggregates(spark: SparkSession, settings: Settings, first_day: dt.date | None = None) -> None:
    """Bring the table of daily aggregates, one row per day, country and category, up to date with the
    staged revenue: the rows of the staged days from first_day on are replaced in one step."""
    staged = read_table(spark, settings, "stg_daily_revenue")
    path, known = table_path(settings, "fact_daily"), read_dataset(spark, table_path(settings, "fact_daily"), AGGREGATES)
    if first_day is not None:
        staged = staged.filter(F.col("order_date") >= first_day)
        known = known.filter(F.col("date_key") >= _day_number(first_day))
    rows = warehouse.replace_aggregates(known, staged)
    first = first_day and _day_number(first_day)
    replace_since(warehouse.as_table(rows, AGGREGATES), path, "date_key", first, scratch_path(spark, "aggregates"))


def publish_catalog(spark: SparkSession, settings: Settings, database: str = "default") -> dict[str, list[str]]:
    """Make bronze, gold and warehouse known in the catalog, with the folders that came since the last
    call, and refresh the statistics of the tables that have new ones. Returns the new folders."""
    datasets = {f"bronze_{t}": (settings.bronze(t), schemas.bronze(t), DATE_PARTS) for t in schemas.TOPIC_SCHEMAS}
    datasets["gold_daily_revenue"] = (settings.gold("daily_revenue"), schemas.GOLD_DAILY_REVENUE, ("order_date",))
    for name, schema in {**_TABLES, "fact_daily": AGGREGATES}.items():
        parts = ("date_key",) if name.startswith("fact_") else ()
        datasets[name] = (table_path(settings, name), schema, parts)
    added = {}
    for name, (path, schema, parts) in datasets.items():
        ensure_folder(spark, path)
        table = f"{database}.{name}"
        added[name] = register_dataset(spark, table, path, schema, parts)
        if added[name] or not parts:
            refresh_statistics(spark, table)
    return added


def refresh_summary(spark: SparkSession, settings: Settings, first_day: dt.date) -> None:
    """Bring the days from first_day on of the daily summary up to date."""
    revenue = metric_table(spark, settings, "revenue_per_minute")
    geo = metric_table(spark, settings, "geographic_metrics")
    recent = F.col("window_start") >= F.lit(first_day).cast("timestamp")
    fresh = warehouse.daily_summary(revenue.filter(recent), geo.filter(recent))
    current = read_dataset(spark, table_path(settings, "daily_summary"), fresh.schema)
    replace_table(
        warehouse.upsert_summary(current, fresh), table_path(settings, "daily_summary"),
        scratch_path(spark, "summary"),
    )


def metric_schema(spark: SparkSession, settings: Settings, name: str) -> StructType:
    empty = spark.createDataFrame([], schemas.bronze(app.METRICS[name].topic))
    return app.metric_frame(name, empty, settings).schema


def metric_table(
    spark: SparkSession, settings: Settings, name: str, state: upsert_log.State | None = None,
    first_day: dt.date | None = None,
) -> DataFrame:
    """The committed rows of a streaming metric, now or at a state taken before."""
    schema = metric_schema(spark, settings, name)
    return upsert_log.read_table(spark, settings.metric(name), schema, app.METRICS[name].keys, state, first_day)


#: The tables of the dashboard. Those of the first kind have rows in every minute with traffic.
STEADY = ("revenue_per_minute", "active_users", "product_metrics", "geographic_metrics")
DASHBOARD = (*STEADY, "failed_payments", "click_windows", "page_windows")


def metric_states(spark: SparkSession, settings: Settings, names: Sequence[str] = DASHBOARD) -> dict[str, upsert_log.State]:
    """The committed states of several metric tables, taken together before any row is read."""
    return {name: upsert_log.state_of(spark, settings.metric(name)) for name in names}


def dashboard(spark: SparkSession, settings: Settings, as_of, minutes: int) -> dict[str, DataFrame]:
    """All panels of the dashboard, from whole batches up to one window that all tables have reached.

    Each table is read at the state it had when the call began, up to the newest window that the
    steady tables share. With a date or time as `as_of`, older days are not listed.
    """
    states = metric_states(spark, settings)
    shared = upsert_log.common_window({n: states[n] for n in STEADY})
    first = None
    if isinstance(as_of, dt.date):
        newest = as_of if isinstance(as_of, dt.datetime) else dt.datetime.combine(as_of, dt.time())
        first = (min(newest, shared or newest) - dt.timedelta(minutes=minutes)).date()

    def table(name: str) -> DataFrame:
        rows = metric_table(spark, settings, name, states[name], first)
        return rows if shared is None else rows.filter(F.col("window_start") <= F.lit(shared).cast("timestamp"))

    windows = table("click_windows")
    tables = {
        "revenue": table("revenue_per_minute"),
        "users": table("active_users"),
        "failed": table("failed_payments"),
        "top_products": kpi.top_products(table("product_metrics")),
        "geo": table("geographic_metrics"),
        "clicks": kpi.clickstream_metrics(windows, table("page_windows")),
    }
    return serving.load_metrics(tables, as_of, minutes)


def table_path(settings: Settings, name: str) -> str:
    return settings.path("warehouse", name)


_TABLES = {
    "dim_date": schemas.DIM_DATE, "dim_users": schemas.DIM_USERS, "dim_products": schemas.DIM_PRODUCTS,
    "fact_orders": schemas.FACT_ORDERS, "fact_payments": schemas.FACT_PAYMENTS,
    "stg_daily_revenue": schemas.STG_DAILY_REVENUE,
}


def read_table(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    return read_dataset(spark, table_path(settings, name), _TABLES[name])


def _store_fact(
    spark: SparkSession, settings: Settings, name: str, facts: DataFrame, grain: str, first_day: dt.date | None
) -> None:
    known = read_table(spark, settings, name)
    numbered = warehouse.number_facts(facts, f"{grain}_id", f"{grain}_key", known)
    replace_since(
        warehouse.as_table(numbered, _TABLES[name]), table_path(settings, name), "date_key",
        first_day and _day_number(first_day), scratch_path(spark, name), [f"{grain}_timestamp"],
    )


def _day_number(day: dt.date) -> int:
    return int(f"{day:%Y%m%d}")
