"""Send this package to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import basketry

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in tasks, once per application.

    The archive lies with the driver only until Spark has taken it over; Spark hands it out.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = Path(basketry.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "basketry_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
