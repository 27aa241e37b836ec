"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from basketry.config import Settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_options(settings: Settings) -> dict[str, str]:
    opts = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Let AQE split a skewed join even if that costs one more shuffle downstream.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if settings.lake_mode != "local":
        opts["spark.hadoop.fs.s3a.impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
        if settings.object_store_endpoint:
            opts["spark.hadoop.fs.s3a.endpoint"] = settings.object_store_endpoint
            opts["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return opts


def create_session(
    app_name: str, settings: Settings | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**session_options(settings or Settings()), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession, settings: Settings) -> SparkSession:
    """A sibling session for stateful queries.

    The number of state partitions is fixed by the first run of a query, so it is
    set here and not taken from the batch setting of the caller.
    """
    session = spark.newSession()
    partitions = settings.state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by spark.checkpoint.dir.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="basketry-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
