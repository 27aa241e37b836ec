"""Retail event analytics written as plain Spark DataFrame transforms.

Every transform takes DataFrames and returns a DataFrame, so the same function
serves a batch table and a stream.
"""

from basketry.config import Settings
from basketry.session import create_session, scratch_path

__all__ = ["Settings", "create_session", "scratch_path"]
