"""Table changes on plain frames: upsert, insert-if-absent, replace by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None
) -> DataFrame:
    """Insert new keys and update the given columns of known ones; both sides unique by key.

    A null in the source does overwrite: presence is judged by a marker, not by the value.
    """
    update = [c for c in target.columns if c not in keys] if update is None else list(update)
    t = target.withColumn("_in_t", F.lit(True)).withColumnsRenamed(
        {c: f"_t_{c}" for c in target.columns if c not in keys}
    )
    s = source.select(*target.columns).withColumn("_in_s", F.lit(True))
    both = t.join(s, list(keys), "full_outer")
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.col(c))
            continue
        from_source = F.col("_in_s") if c in update else F.col("_in_t").isNull()
        columns.append(F.when(from_source, F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c))
    return both.select(*columns)


def rows_to_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target does not have."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def replace_by_key(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop all target rows whose key is staged, then add the staged rows."""
    # Distinct first: one row per staged key is sent, not one per staged row.
    known = staged.select(*keys).distinct()
    kept = target.join(known, list(keys), "left_anti")
    return kept.unionByName(staged.select(*target.columns))
