"""Batch tables written partition by partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from basketry.sources.files import NO_VALUE, delete_folder, folder_names


def replace_partitions(
    rows: DataFrame, path: str, partitions: Sequence[str], staging: str, sort: Sequence[str] = ()
) -> None:
    """Replace the partitions that occur in the rows and leave all others alone.

    The rows go to a staging folder first, so a plan that reads the target has finished before
    the target changes. Rebalance evens out the files and splits a partition that is too large.
    """
    even = rows.hint("rebalance", *partitions)
    if sort:
        even = even.sortWithinPartitions(*partitions, *sort)
    even.write.mode("overwrite").parquet(staging)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(staging)
    staged.write.partitionBy(*partitions).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)
    delete_folder(rows.sparkSession, staging)


def replace_since(
    rows: DataFrame, path: str, partition: str, first: object, staging: str, sort: Sequence[str] = ()
) -> None:
    """Replace all partitions whose value is `first` or more, or with None the whole table.

    A replaced partition that has no rows now goes. `partition` holds days, as dates or as
    numbers of eight digits, so their list is short. Rows without a day have a folder of their
    own, which is replaced if the rows have any and else stays.
    """
    spark = rows.sparkSession
    even = rows.hint("rebalance", partition)
    if sort:
        even = even.sortWithinPartitions(partition, *sort)
    even.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    staged.write.partitionBy(partition).mode("overwrite").option(
        "partitionOverwriteMode", "static" if first is None else "dynamic"
    ).parquet(path)
    if first is not None:
        filled = {f"{partition}={r[0]}" for r in staged.select(partition).distinct().collect()}
        for name in folder_names(spark, path):
            day = name.removeprefix(f"{partition}=")
            if day != name and day != NO_VALUE and day >= str(first) and name not in filled:
                delete_folder(spark, f"{path.rstrip('/')}/{name}")
    delete_folder(spark, staging)


def replace_table(rows: DataFrame, path: str, staging: str) -> None:
    """Replace a whole table; the rows may come from the table itself."""
    rows.write.mode("overwrite").parquet(staging)
    rows.sparkSession.read.schema(rows.schema).parquet(staging).write.mode("overwrite").parquet(path)
    delete_folder(rows.sparkSession, staging)


def write_ranked(rows: DataFrame, path: str, by: str, staging: str) -> None:
    """A whole table laid out by descending value, for readers that want the top first."""
    order = F.col(by).desc()
    replace_table(rows.repartitionByRange(order).sortWithinPartitions(order), path, staging)
