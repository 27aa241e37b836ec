"""Parquet datasets in the lake."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketry.operators.skew import estimated_bytes

# Fixed value: the folder name of a null partition.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or a small folder exists; not for whole datasets, which it would list."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, so that a stream may start on it before its first file arrives."""
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it is missing."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()]


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A file of a few lines that readers see as a whole or not at all."""
    files, place = _file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(place):
        files.delete(place, False)
    if not files.rename(hidden, place):
        raise OSError(f"cannot write {path}")


def read_small_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and text of the files in a folder of small files; hidden ones are left out. One that
    goes away meanwhile is left out too."""
    files, place = _file_system(spark, folder)
    if not files.exists(place):
        return {}
    out = {}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        try:
            stream = files.open(status.getPath())
        except Py4JJavaError as e:
            if "FileNotFound" in str(e.java_exception):
                continue
            raise
        try:
            out[name] = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
    return out


def read_dataset(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A partitioned dataset, or an empty frame if nothing was written yet.

    Only a missing path counts as "no data yet"; any other failure is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_for_cores(df: DataFrame, at_least: int = 1 << 20, at_most: int = 1 << 28) -> DataFrame:
    """Re-split a small table that comes as fewer pieces than there are cores.

    A file with one row group is read by one task, and all work on its rows would stay there.
    The rows go by their first column, which is even enough below `at_most` bytes. Tables of
    many files are left as they are.
    """
    size = estimated_bytes(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size is None or not at_least <= size <= at_most or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, df.columns[0])


def stream_dataset(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
