"""Which checkpoint a sink belongs to.

A file sink skips batch numbers it has already committed. With a fresh checkpoint the numbers
start at 0 again, so new rows would be skipped without an error. A sink is therefore only
opened with the checkpoint it was written with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from basketry.sources.files import path_exists


_MANIFEST = "number int, checkpoint string"


class PairingError(RuntimeError):
    pass


@dataclass(frozen=True)
class Run:
    number: int


def check_pairing(spark: SparkSession, sink: str, checkpoint: str) -> None:
    """Refuse a file sink that holds committed batches when its checkpoint is gone."""
    if path_exists(spark, f"{sink.rstrip('/')}/_spark_metadata") and not path_exists(
        spark, f"{checkpoint.rstrip('/')}/offsets"
    ):
        raise PairingError(
            f"{sink} holds batches of another run but {checkpoint} is empty; use a new sink folder"
        )


def open_run(spark: SparkSession, table: str, checkpoint: str) -> Run:
    """The run of a checkpoint on an upsert log; a new checkpoint gets the next number.

    The manifest folder of the table holds one small row per run.
    """
    manifest = f"{table.rstrip('/')}/_runs"
    known = []
    if path_exists(spark, manifest):
        known = spark.read.schema(_MANIFEST).json(manifest).collect()
    for row in known:
        if row.checkpoint == checkpoint:
            return Run(row.number)
    run = Run(1 + max((row.number for row in known), default=0))
    row = spark.createDataFrame([(run.number, checkpoint)], _MANIFEST)
    row.coalesce(1).write.mode("append").json(manifest)
    return run
