"""The test tables in the roles the library works on (the library knows none of them).

    order events      lineitem with orders, part, customer and nation (day precision)
    orders topic      events: purchase = order placed, signup = order returned
    payments          events: purchase = success, error = failed
    clicks            events: view and click
    user activity     all events
    stock updates     events: view
    change feed       orders as inserts, lineitem as later updates and deletes
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from basketry import schemas
from basketry.functions.parse import parse_events
from basketry.functions.scalars import stock_after
from basketry.operators.skew import lookup_join
from basketry.sources.files import split_for_cores

# Columns of the test tables.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}
REASONS = ("too small", "too large", "broken", "not as shown")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return split_for_cores(spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet"))


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream; the pattern lets the table be one file or a folder of files."""
    return spark.readStream.schema(TABLES[name]).parquet(f"{sf}/{{{name}}}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a zoned event_time and the number k of their properties."""
    return _timed(table(spark, sf, "events"))


def events_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _timed(table_stream(spark, sf, "events"))


def _timed(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.withColumn("event_time", F.col("ts").cast("timestamp")).withColumn("k", k)


def _id(prefix: str, number: Column | None = None) -> Column:
    number = F.col("event_id") if number is None else number
    return F.concat(F.lit(prefix), number.cast("string"))


def _sku() -> Column:
    return F.concat(F.lit("SKU-"), F.col("k").cast("string"))


def orders_topic(ev: DataFrame) -> DataFrame:
    """Placed and returned orders as they come mixed on one topic."""
    placed = F.col("event_type") == "purchase"
    reason = F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.col("k") % 4 + 1)
    return ev.filter(F.col("event_type").isin("purchase", "signup")).select(
        F.when(placed, "order_placed").otherwise("order_returned").alias("event_type"),
        _id("o").alias("order_id"),
        F.when(~placed, _id("r")).alias("return_id"),
        F.col("user_id").cast("string").alias("user_id"),
        _sku().alias("product_id"),
        F.concat(F.lit("Product "), F.col("k").cast("string")).alias("product_name"),
        F.concat(F.lit("Category "), (F.col("k") % 5).cast("string")).alias("category"),
        (F.col("k") % 3 + 1).alias("quantity"),
        F.when(placed, F.col("value")).alias("total_amount"),
        F.when(~placed, F.col("value")).alias("refund_amount"),
        F.when(~placed, reason).alias("reason"),
        F.concat(F.lit("Country "), (F.col("k") % 10).cast("string")).alias("country"),
        F.lit("confirmed").alias("order_status"),
        "event_time",
    )


def minute_orders(ev: DataFrame) -> DataFrame:
    return orders_topic(ev.filter(F.col("event_type") == "purchase"))


def minute_returns(ev: DataFrame) -> DataFrame:
    return orders_topic(ev.filter(F.col("event_type") == "signup"))


def payments(ev: DataFrame) -> DataFrame:
    failed = F.col("event_type") == "error"
    return ev.filter(F.col("event_type").isin("purchase", "error")).select(
        _id("p").alias("payment_id"),
        # A failed attempt belongs to the event before it, which may be an order.
        _id("o", F.col("event_id") - failed.cast("int")).alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("amount"),
        F.concat(F.lit("method "), (F.col("k") % 5).cast("string")).alias("payment_method"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, "declined").alias("failure_reason"),
        "event_time",
    )


def clicks(ev: DataFrame, kind: bool = False) -> DataFrame:
    return ev.filter(F.col("event_type").isin("view", "click")).select(
        *(["event_type"] if kind else []),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("/p"), F.col("k").cast("string")).alias("page_url"),
        "event_time",
    )


def activity(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("user_id").cast("string").alias("user_id"), "event_time")


def stock_updates(ev: DataFrame) -> DataFrame:
    delta = F.col("k") - 50
    before = (F.col("event_id") * 7 + 13) % 60
    return ev.filter(F.col("event_type") == "view").select(
        _id("s").alias("update_id"),
        _sku().alias("product_id"),
        F.concat(F.lit("WH-"), (F.col("k") % 4).cast("string")).alias("warehouse_id"),
        delta.cast("int").alias("quantity_delta"),
        before.cast("int").alias("previous_stock"),
        stock_after(before, delta).cast("int").alias("new_stock"),
        "event_time",
    )


def as_records(rows: DataFrame, topic: str, key: str, position: Column, schema: StructType) -> DataFrame:
    """Rows as Kafka records whose value is the JSON of the event contract."""
    iso = F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    fields = [F.col(f.name) for f in schema if f.name in rows.columns]
    return rows.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*fields, iso.alias("timestamp"))).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        position.cast("bigint").alias("offset"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def order_records(ev: DataFrame) -> DataFrame:
    rows = orders_topic(ev).withColumn("_n", F.substring("order_id", 2, 20))
    return as_records(rows, "orders", "order_id", F.col("_n"), schemas.ORDERS_TOPIC)


def parsed_orders(ev: DataFrame) -> DataFrame:
    return parse_events(order_records(ev), schemas.ORDERS_TOPIC)


def _line_amount() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("double")


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """Order grain; (l_orderkey, l_linenumber) repeats, so this table needs cleaning."""
    get = partial(table, spark, sf)
    lines = get("lineitem").withColumnsRenamed({"l_orderkey": "o_orderkey", "l_partkey": "p_partkey"})
    read, orders = lines, get("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    buyers = get("customer").join(get("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    buyers = buyers.select(F.col("c_custkey").alias("o_custkey"), "n_name")
    # Buyers join the orders, of which there are fewer than lines, so lines move once less.
    placed = lookup_join(orders, buyers, ["o_custkey"], "inner", get("customer"))
    lines = lookup_join(lines, placed, ["o_orderkey"], "inner", get("orders"), read)
    lines = lookup_join(lines, get("part"), ["p_partkey"], "inner", counted=read)
    return lines.select(
        F.concat_ws("-", "o_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        _line_amount().alias("total_amount"),
        F.col("n_name").alias("country"),
        F.concat(F.lit(" "), "o_orderstatus").alias("order_status"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def user_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as dim_users input; first seen with their first order."""
    first = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.min("o_orderdate")).alias("first_seen_date")
    )
    people = table(spark, sf, "customer").join(first, "c_custkey", "left")
    nation = table(spark, sf, "nation")
    return people.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("city"),
        "first_seen_date",
    )


def product_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sku"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
    )


def product_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Dated changes of a product's rate and status, as seen in its line items."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_shipdate").cast("timestamp").alias("changed_at"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("is_deleted"),
        F.col("l_tax").alias("rate"),
        F.col("l_linestatus").alias("status"),
        F.col("l_orderkey").alias("change_id"),
        F.col("l_linenumber").alias("change_line"),
    )


def _change(topic: str, key: str, value: Column, time: str, offset: Column) -> list[Column]:
    return [
        F.to_json(F.struct(F.col(key).alias("order_id"))).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.col(time).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ]


def change_records(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders as insert envelopes, line items as bare rows: statuses and deletes."""
    topic = "ecommerce_cdc.ecommerce_cdc.orders"
    order_row = F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
    )
    envelope = F.to_json(
        F.struct(
            F.lit("c").alias("op"),
            order_row.alias("after"),
            F.struct(F.lit("orders").alias("table"), F.lit("ecommerce").alias("db")).alias("source"),
        )
    )
    gone = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    bare = F.to_json(
        F.struct(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_suppkey").alias("customer_id"),
            F.col("l_returnflag").alias("order_status"),
            gone.cast("string").alias("__deleted"),
        )
    )
    # Offsets must be unique within a key; line number and part make them so.
    position = F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey") * F.lit(10**5) + F.col("l_suppkey") + 1
    inserts = orders.select(*_change(topic, "o_orderkey", envelope, "o_orderdate", F.lit(0)))
    return inserts.unionByName(lines.select(*_change(topic, "l_orderkey", bare, "l_shipdate", position)))


def latest(df: DataFrame, time: str) -> Column:
    """The newest time in a table: the `as_of` of the queries, in place of a clock."""
    return df.agg(F.max(time)).scalar()
