"""Event contracts and warehouse tables: the only place where schemas are declared."""

from pyspark.sql.types import StructType


_JSON_NAMES = {"int": "integer", "bigint": "long", "smallint": "short"}


def _schema(*columns: str) -> StructType:
    """A schema from "name type" texts, without the need for a running session."""
    out = StructType()
    for column in columns:
        name, kind = column.split(" ")
        out = out.add(name, _JSON_NAMES.get(kind, kind))
    return out


def select(schema: StructType, *names: str) -> StructType:
    """Some fields of a schema, in the order of the names."""
    return StructType([schema[name] for name in names])


# Field names and types of the JSON events.
ORDER_PLACED = _schema(
    "event_type string", "order_id string", "user_id string", "session_id string",
    "product_id string", "product_name string", "category string", "quantity int",
    "unit_price double", "total_amount double", "currency string", "country string",
    "city string", "order_status string", "timestamp string",
)
ORDER_RETURNED = _schema(
    "event_type string", "return_id string", "order_id string", "user_id string",
    "product_id string", "product_name string", "quantity int", "refund_amount double",
    "reason string", "country string", "city string", "timestamp string",
)
PAYMENT_PROCESSED = _schema(
    "event_type string", "payment_id string", "order_id string", "user_id string",
    "amount double", "currency string", "payment_method string", "status string",
    "failure_reason string", "country string", "timestamp string",
)
PAGE_VIEW = _schema(
    "event_type string", "event_id string", "session_id string", "user_id string",
    "page_url string", "referrer string", "device string", "country string",
    "city string", "duration_seconds int", "timestamp string",
)
USER_ACTIVITY = _schema(
    "event_type string", "activity_id string", "user_id string", "session_id string",
    "activity_type string", "country string", "city string", "device string",
    "timestamp string",
)
INVENTORY_UPDATE = _schema(
    "event_type string", "update_id string", "product_id string", "product_name string",
    "category string", "change_type string", "quantity_delta int", "previous_stock int",
    "new_stock int", "warehouse_id string", "timestamp string",
)

# The orders topic carries two kinds of event; it is read with the union of their fields.
ORDERS_TOPIC = StructType(
    ORDER_PLACED.fields
    + [f for f in ORDER_RETURNED.fields if f.name not in ORDER_PLACED.fieldNames()]
)

TOPIC_SCHEMAS = {
    "orders": ORDERS_TOPIC,
    "payments": PAYMENT_PROCESSED,
    "clicks": PAGE_VIEW,
    "users": USER_ACTIVITY,
    "inventory": INVENTORY_UPDATE,
}

KAFKA = _schema(
    "key binary", "value binary", "topic string", "partition int", "offset bigint",
    "timestamp timestamp", "timestampType int",
)

_BRONZE_EXTRA = _schema(
    "value string", "topic string", "partition int", "offset bigint",
    "event_time timestamp", "year int", "month int", "day int",
)


def bronze(topic: str) -> StructType:
    return StructType(TOPIC_SCHEMAS[topic].fields + _BRONZE_EXTRA.fields)


CDC_SILVER = _schema(
    "cdc_topic string", "record_key string", "payload string", "kafka_timestamp timestamp",
    "partition int", "offset bigint", "processed_at timestamp", "operation string",
    "table_name string", "year int", "month int", "day int",
)

# Source tables behind the change feed.
CDC_ROWS = {
    "customers": _schema(
        "customer_id int", "email string", "first_name string", "last_name string",
        "country string", "city string", "created_at string", "updated_at string",
    ),
    "products": _schema(
        "product_id int", "sku string", "name string", "category string",
        "price decimal(12,2)", "stock_quantity int", "is_active boolean",
        "created_at string", "updated_at string",
    ),
    "orders": _schema(
        "order_id int", "customer_id int", "order_status string",
        "total_amount decimal(12,2)", "shipping_country string", "created_at string",
        "updated_at string",
    ),
    "inventory_log": _schema(
        "log_id int", "product_id int", "change_type string", "quantity_delta int",
        "previous_stock int", "new_stock int", "created_at string",
    ),
}

# Columns of the warehouse tables.
GOLD_DAILY_REVENUE = _schema(
    "order_date date", "country string", "category string", "total_revenue double",
    "order_count bigint", "avg_order_value double", "unique_customers bigint",
)
STG_DAILY_REVENUE = _schema(
    "order_date date", "country string", "category string", "total_revenue decimal(14,2)",
    "order_count int", "avg_order_value decimal(12,2)", "unique_customers int",
    "etl_processed_at timestamp",
)
DIM_DATE = _schema(
    "date_key int", "full_date date", "year smallint", "quarter smallint", "month smallint",
    "month_name string", "week_of_year smallint", "day_of_month smallint",
    "day_of_week smallint", "day_name string", "is_weekend boolean", "is_holiday boolean",
)
DIM_USERS = _schema(
    "user_key bigint", "user_id string", "country string", "city string",
    "first_seen_date date", "is_active boolean", "effective_from timestamp",
    "effective_to timestamp", "is_current boolean",
)
DIM_PRODUCTS = _schema(
    "product_key bigint", "product_id string", "product_name string", "category string",
    "sku string", "unit_price decimal(12,2)", "is_active boolean",
    "effective_from timestamp", "effective_to timestamp", "is_current boolean",
)
FACT_ORDERS = _schema(
    "order_key bigint", "order_id string", "date_key int", "user_key bigint",
    "product_key bigint", "order_status string", "quantity int", "unit_price decimal(12,2)",
    "total_amount decimal(14,2)", "discount_amount decimal(12,2)", "tax_amount decimal(12,2)",
    "shipping_country string", "order_timestamp timestamp", "etl_loaded_at timestamp",
)
FACT_PAYMENTS = _schema(
    "payment_key bigint", "payment_id string", "order_id string", "date_key int",
    "user_key bigint", "amount decimal(14,2)", "payment_method string",
    "payment_status string", "failure_reason string", "payment_timestamp timestamp",
    "etl_loaded_at timestamp",
)
