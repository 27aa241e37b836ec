"""SQL databases as a place to read metric tables from and to publish them to."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, user: str, password: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "driver": driver}


def read_query(spark: SparkSession, options: dict[str, str], query: str) -> DataFrame:
    """Rows of a query; a failure is raised and not turned into an empty frame."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def merge_statement(table: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """One statement that moves staged rows into a keyed table."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    action = f"DO UPDATE SET {updates}" if updates else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {stage} "
        f"ON CONFLICT ({', '.join(keys)}) {action}"
    )


def publish(
    df: DataFrame,
    options: dict[str, str],
    table: str,
    keys: Sequence[str],
    execute: Callable[[str], None],
    connections: int = 8,
) -> None:
    """Stage the rows through Spark's JDBC writer, then merge them by key.

    `execute` runs one statement on the database. Publishing the same rows again changes
    nothing.
    """
    stage = f"{table}_stage"
    writer = df.write.format("jdbc").options(**options).option("dbtable", stage)
    writer.option("truncate", "true").option("numPartitions", connections).mode("overwrite").save()
    execute(merge_statement(table, stage, keys, df.columns))
