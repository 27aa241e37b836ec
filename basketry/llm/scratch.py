"""Intermediate tables in the shared folder, and reading of groups from sorted partitions."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm.ship import ship
from basketry.session import scratch_path


class Scratch:
    """Tables written below spark.checkpoint.dir; any executor can read or rebuild them.

    A table that a returned frame still reads must stay until the caller is done with it, so
    only `drop` removes one.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.name = name
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Have Spark remove the shuffle files that nothing refers to any more. It does so when the
        driver's JVM collects garbage, which one that has little to do puts off until disks are full.
        Threads that end and events that are handed out hold on to the last query for a moment."""
        time.sleep(1)
        self.spark._jvm.System.gc()


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a partition that is sorted by `keys`, several at once.

    Yields tables that end where a group ends, so a group is never cut. At most one group and
    one batch are held.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        last = table.num_rows - 1
        lo, hi = 0, last
        tail = [table.column(k)[last] for k in keys]
        while lo < hi:  # first row of the last group
            mid = (lo + hi) // 2
            if [table.column(k)[mid] for k in keys] == tail:
                hi = mid
            else:
                lo = mid + 1
        if lo:
            yield table.slice(0, lo)
        rest = table.slice(lo)
    if rest is not None and rest.num_rows:
        yield rest


def text_column(docs: DataFrame, text: str) -> DataFrame:
    """The frame with null texts as empty ones."""
    return docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
