"""Top-k, first and latest rows.

All rest on `row_number() <= k`, which Spark also applies before the shuffle: each map
task sends at most k rows per group, so a group of any size is cut down where it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank_position"
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first by the given order, then by all other columns."""
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_k_per_group(df, keys, [*order, *ties], 1, "_rn").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the last by the given columns."""
    return top_k_per_group(df, keys, [F.col(c).desc_nulls_last() for c in order], 1, "_rn").drop("_rn")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows overall (each task keeps n, the driver merges them)."""
    return df.orderBy(*order).limit(n)
