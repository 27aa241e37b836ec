"""Star schema: dimensions, facts, staging and the daily summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketry import schemas
from basketry.functions.dates import calendar_columns, date_key, since_minutes
from basketry.functions.scalars import money, normalized, ratio
from basketry.operators.keys import assign_keys, last_key
from basketry.operators.skew import lookup_join
from basketry.operators.upsert import replace_by_key, rows_to_insert, upsert
from basketry.operators.versions import as_of_lookup, scd2

AGGREGATED = "aggregated"
FACT_KEY_DIGITS = 4


def dim_date(dates: DataFrame, date: str, holidays: DataFrame | None = None) -> DataFrame:
    """Every day from the first to the last date found; holidays is a frame of full_date."""
    span = dates.agg(F.to_date(F.min(date)).alias("lo"), F.to_date(F.max(date)).alias("hi"))
    # No dates at all give no rows: a sequence of nulls is null.
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    out = days.withColumns(calendar_columns("full_date"))
    if holidays is None:
        out = out.withColumn("is_holiday", F.lit(False))
    else:
        marked = holidays.select("full_date").distinct().withColumn("is_holiday", F.lit(True))
        out = out.join(marked, "full_date", "left").fillna(False, ["is_holiday"])
    return as_table(out, schemas.DIM_DATE)


def seed_dimension(existing: DataFrame, incoming: DataFrame, natural: str, key: str) -> DataFrame:
    """The new members of a dimension, keyed on from the highest key; known ones stay."""
    new = rows_to_insert(existing, incoming, [natural])
    return assign_keys(new, [natural], key, last_key(existing, key))


def user_versions(orders: DataFrame) -> DataFrame:
    """Versions of users, from the country and city their orders name."""
    changes = orders.filter(F.col("user_id").isNotNull()).withColumn("is_deleted", F.lit(False))
    versions = scd2(changes, ["user_id"], "event_time", ["country", "city"], ["order_id"])
    first = versions.groupBy("user_id").agg(F.to_date(F.min("effective_from")).alias("first_seen_date"))
    return lookup_join(versions, first, ["user_id"], "inner", counted=changes).withColumn(
        "is_active", F.lit(True)
    )


def product_versions(orders: DataFrame) -> DataFrame:
    """Versions of products, from the name, category and price their orders name."""
    priced = orders.filter(F.col("product_id").isNotNull()).withColumns(
        {"is_deleted": F.lit(False), "unit_price": F.col("unit_price").try_cast("decimal(12,2)")}
    )
    attributes = ["product_name", "category", "unit_price"]
    versions = scd2(priced, ["product_id"], "event_time", attributes, ["order_id"])
    return versions.withColumns({"sku": F.col("product_id"), "is_active": F.lit(True)})


def build_dimension(
    versions: DataFrame, natural: list[str], key: str, existing: DataFrame | None = None
) -> DataFrame:
    """Number all versions of a dimension; those that the stored table knows keep their key."""
    return assign_keys(versions, natural, key, existing=existing)


def open_versions(rows: DataFrame, effective_from: Column) -> DataFrame:
    """Rows without a history as versions that are valid from a given time on."""
    return rows.withColumns(
        {
            "is_active": F.lit(True),
            "effective_from": effective_from,
            "effective_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


@dataclass(frozen=True)
class Dimension:
    """A dimension to look keys up in, with what is known of its size (see as_of_lookup)."""

    rows: DataFrame
    stored: DataFrame | None = None
    counted: DataFrame | None = None
    versions_per_key: int | None = None


def with_dimension_keys(
    fact: DataFrame, users: Dimension | None, products: Dimension | None
) -> DataFrame:
    """Surrogate keys of the versions valid at the time of the event; null without dimension."""
    for name, dim in (("user", users), ("product", products)):
        if dim is None:
            fact = fact.withColumn(f"{name}_key", F.lit(None).cast("bigint"))
        else:
            fact = as_of_lookup(
                fact, dim.rows, [f"{name}_id"], "event_time", [f"{name}_key"], dim.stored, dim.counted,
                dim.versions_per_key,
            )
    return fact


def fact_orders(keyed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Order-grain facts from cleaned orders that carry dimension keys (order_key not yet set)."""
    given = {c: F.col(c) if c in keyed.columns else F.lit(0) for c in ("discount_amount", "tax_amount")}
    return keyed.select(
        "order_id",
        date_key(F.to_date("event_time")).alias("date_key"),
        "user_key",
        "product_key",
        normalized("order_status").alias("order_status"),
        F.coalesce("quantity", F.lit(1)).alias("quantity"),
        F.col("unit_price").try_cast("decimal(12,2)").alias("unit_price"),
        money("total_amount").cast("decimal(14,2)").alias("total_amount"),
        *[value.try_cast("decimal(12,2)").alias(name) for name, value in given.items()],
        F.col("country").alias("shipping_country"),
        F.col("event_time").alias("order_timestamp"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("etl_loaded_at"),
    )


def fact_payments(keyed: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return keyed.select(
        "payment_id",
        "order_id",
        date_key(F.to_date("event_time")).alias("date_key"),
        "user_key",
        money("amount").cast("decimal(14,2)").alias("amount"),
        "payment_method",
        F.col("status").alias("payment_status"),
        F.when(F.col("status") == "failed", F.col("failure_reason")).alias("failure_reason"),
        F.col("event_time").alias("payment_timestamp"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("etl_loaded_at"),
    )


def number_facts(facts: DataFrame, natural: str, key: str, existing: DataFrame | None = None) -> DataFrame:
    """Set the key; facts that the stored table knows keep theirs."""
    return assign_keys(facts, [natural], key, 0, FACT_KEY_DIGITS, existing)


def stage_daily_revenue(gold: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Gold rows by name in the types of the staging table.

    The mean is taken anew from total and count, both exact, so that halves of a cent round up;
    the double in the gold table may lie just below one.
    """
    now = F.current_timestamp() if processed_at is None else processed_at
    total = F.col("total_revenue").cast("decimal(20,2)")
    mean = F.round(F.try_divide(total, F.col("order_count").cast("decimal(20,0)")), 2)
    rows = gold.withColumns({"etl_processed_at": now, "avg_order_value": mean})
    return as_table(rows, schemas.STG_DAILY_REVENUE)


def aggregate_facts(staged: DataFrame) -> DataFrame:
    """Staged daily revenue in the shape of order facts, one per day, country and category."""
    return staged.select(
        F.concat_ws("-", F.lit("AGG"), F.col("order_date").cast("string"), "country", "category").alias("order_id"),
        date_key("order_date").alias("date_key"),
        F.lit(AGGREGATED).alias("order_status"),
        F.col("order_count").cast("int").alias("quantity"),
        F.col("avg_order_value").cast("decimal(12,2)").alias("unit_price"),
        F.col("total_revenue").cast("decimal(14,2)").alias("total_amount"),
        F.col("country").alias("shipping_country"),
        F.col("order_date").cast("timestamp").alias("order_timestamp"),
    )


def replace_aggregates(facts: DataFrame, staged: DataFrame) -> DataFrame:
    """Swap the aggregate rows of the staged days; rows of single orders are never touched."""
    rows = aggregate_facts(staged)
    single = facts.filter(F.col("order_status") != AGGREGATED)
    aggregates = facts.filter(F.col("order_status") == AGGREGATED)
    return single.unionByName(replace_by_key(aggregates, rows, ["date_key"]).select(*facts.columns))


def daily_summary(revenue: DataFrame, geo: DataFrame) -> DataFrame:
    """Per-minute metrics by day; both the plain mean of minutes and the weighted mean."""
    day = F.to_date("window_start").alias("report_date")
    minute_aov = ratio(F.col("total_revenue"), F.col("order_count"))
    totals = revenue.groupBy(day).agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"),
        F.coalesce(F.avg(minute_aov), F.lit(0.0)).alias("avg_minute_aov"),
        F.coalesce(ratio(F.sum("total_revenue"), F.sum("order_count")), F.lit(0.0)).alias("aov"),
    )
    countries = geo.groupBy(day).agg(F.count_distinct("country").alias("unique_countries"))
    return totals.join(countries, "report_date", "left").fillna(0, ["unique_countries"])


def last_day_summary(revenue: DataFrame, geo: DataFrame, as_of: Column) -> DataFrame:
    """The same over the 24 hours before as_of, as one row dated as_of."""
    recent = since_minutes("window_start", as_of, 24 * 60)
    countries = geo.filter(recent).agg(F.count_distinct("country")).scalar()
    minute_aov = ratio(F.col("total_revenue"), F.col("order_count"))
    row = revenue.filter(recent).agg(
        F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"),
        F.coalesce(F.avg(minute_aov), F.lit(0.0)).alias("avg_minute_aov"),
    )
    return row.select(F.to_date(as_of).alias("report_date"), "*", countries.alias("unique_countries"))


def upsert_summary(table: DataFrame, fresh: DataFrame) -> DataFrame:
    return upsert(table, fresh, ["report_date"])


def as_table(df: DataFrame, schema) -> DataFrame:
    """Columns picked by name, in the order and types of the table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
