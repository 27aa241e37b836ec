"""Surrogate keys without passing all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F


def assign_keys(
    df: DataFrame, natural: Sequence[str], key: str, after: int | Column = 0, hex_digits: int = 3,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Number the rows, whose natural key must be unique; all numbers lie above `after`.

    With the table that was stored before, `existing`, rows that it knows keep their number and
    all others get one above its highest. A null is a natural key like any other.

    Rows fall into 16**hex_digits even buckets by the first digits of the digest of their
    natural key, and bucket b of n hands out b + 1, b + 1 + n, b + 1 + 2n and so on. The buckets
    need to know nothing of each other, so one pass is enough. The numbers have gaps, as those
    of a database have. A replay gives the same ones.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural])
    rows = df
    if existing is not None:
        after = last_key(existing, key)
        stored = existing.select(*[F.col(c).alias(f"_s_{c}") for c in natural], F.col(key).alias("_known"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in natural])
        rows = df.join(stored, same, "left")
    known = F.col("_known") if existing is not None else F.lit(None).cast("bigint")
    # The digest travels as its 16 bytes, which sort as its text does.
    hashed = rows.withColumns({
        "_digest": F.unhex(F.md5(text)),
        "_bucket": F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("int"),
    })
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(known.isNotNull(), "_digest", *natural))
    start = after if isinstance(after, Column) else F.lit(after)
    number = start + (rank.cast("bigint") - 1) * 16**hex_digits + F.col("_bucket") + 1
    return hashed.withColumn("_number", F.coalesce(known, number).cast("bigint")).select(
        F.col("_number").alias(key), *df.columns
    )


def last_key(table: DataFrame, key: str) -> Column:
    """The highest key of a table, or 0, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
