"""Catalog tables over lake datasets."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketry.sources.files import NO_VALUE, folder_names, read_dataset


def table_or_path(spark: SparkSession, table: str, path: str, schema: StructType) -> DataFrame:
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return read_dataset(spark, path, schema)


def register_dataset(
    spark: SparkSession, table: str, path: str, schema: StructType, partitions: Sequence[str] = ()
) -> list[str]:
    """Make a dataset known, add columns new in the declared schema, register new folders.

    Nothing is dropped, and no file is opened to learn the schema. Folders are listed level by
    level and held against those that the catalog knows; only new ones are registered, and they
    are returned.
    """
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{path}'")
    else:
        known = set(spark.table(table).columns)
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
    # A folder that a stream writes is no partitioned table: the log of its sink names the files.
    parted = any(c.isPartition for c in spark.catalog.listColumns(table))
    added = new_folders(spark, table, path, partitions) if parted else []
    for lo in range(0, len(added), 100):
        specs = " ".join(f"PARTITION ({_spec(folder)}) LOCATION '{path.rstrip('/')}/{folder}'" for folder in added[lo : lo + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)
    return added


def new_folders(spark: SparkSession, table: str, path: str, partitions: Sequence[str]) -> list[str]:
    """Folders of the dataset, such as year=2024/month=1/day=2, that the catalog does not know."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # one line per folder
    found = [""]
    for column in partitions:
        found = [
            f"{parent}/{name}".lstrip("/") for parent in found
            for name in folder_names(spark, f"{path.rstrip('/')}/{parent}") if name.startswith(f"{column}=")
        ]
    return sorted(set(found) - known)


def _spec(folder: str) -> str:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return ", ".join(f"`{name}` = '{unquote(value)}'" if value != NO_VALUE else f"`{name}` = NULL" for name, value in pairs)


def refresh_statistics(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    suffix = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{suffix}")
