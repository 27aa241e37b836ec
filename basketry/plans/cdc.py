"""Change records to silver, to current state and to version histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from basketry.functions.dates import with_date_parts
from basketry.functions.scalars import table_of_topic
from basketry.operators.ranking import latest_per_key
from basketry.operators.versions import scd2

# Changes of one key sit in one partition, so these columns order them fully.
CHANGE_ORDER = ("kafka_timestamp", "partition", "offset")


def silver(records: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Raw change records with table, operation and the date of processing.

    operation is c, u, d or r from an envelope, u or d from a bare row, t for a record
    without a value.
    """
    out = records.select(
        F.col("topic").alias("cdc_topic"),
        F.col("key").cast("string").alias("record_key"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        "offset",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        table_of_topic("topic").alias("table_name"),
    )
    # One look at the text gives both marks.
    marked = out.select("*", F.json_tuple("payload", "op", "__deleted").alias("_op", "_deleted"))
    operation = (
        F.when(F.col("payload").isNull(), "t")
        .when(F.lower("_deleted") == "true", "d")
        .otherwise(F.coalesce("_op", F.lit("u")))
    )
    return with_date_parts(marked.withColumn("operation", operation).drop("_op", "_deleted"), "processed_at")


def _rows_of(silver_rows: DataFrame, table: str) -> DataFrame:
    return silver_rows.filter((F.col("table_name") == table) & F.col("payload").isNotNull())


def changes(silver_rows: DataFrame, table: str, schema: StructType) -> DataFrame:
    """Typed change rows of one table; tombstones carry no row and are left out.

    The row is that after the change, else that before it, else the bare payload: one schema
    covers all three, so each text is parsed once.
    """
    envelope = StructType(list(schema.fields)).add("after", schema).add("before", schema)
    parsed = _rows_of(silver_rows, table).select(
        F.from_json("payload", envelope).alias("e"),
        "record_key",
        (F.col("operation") == "d").alias("is_deleted"),
        *CHANGE_ORDER,
    )
    bare = F.struct(*[F.col(f"e.{c}").alias(c) for c in schema.fieldNames()])
    row = F.coalesce("e.after", "e.before", bare)
    return parsed.select(F.inline(F.array(row)), "record_key", "is_deleted", *CHANGE_ORDER)


def current_state(
    silver_rows: DataFrame, table: str, schema: StructType, keys: Sequence[str]
) -> DataFrame:
    """The rows that exist after all changes."""
    last = latest_per_key(changes(silver_rows, table, schema), keys, CHANGE_ORDER)
    return last.filter(~F.col("is_deleted")).select(*schema.fieldNames())


def history(
    silver_rows: DataFrame, table: str, schema: StructType, keys: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """All versions of the rows of a table, with the time span each was valid.

    Heavy keys are counted by the record key, for which no payload has to be parsed.
    """
    return scd2(
        changes(silver_rows, table, schema), keys, "kafka_timestamp", attributes,
        ("partition", "offset"), counted=_rows_of(silver_rows, table), by=["record_key"],
    )
