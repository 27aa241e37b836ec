"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Spark's own default limit for a broadcast side, in bytes.
BROADCAST_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame; for a stored table, the size of its files."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(plan.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= BROADCAST_BYTES


def heavy_keys(
    df: DataFrame, on: Sequence[str], share: int | None = None, time: str | None = None
) -> DataFrame:
    """Keys holding more than 1/share of the rows, with the number of parts to cut each into.

    Without `share`, these are the keys that hold more rows than an average shuffle partition.
    There are fewer than `share` such keys, whatever the data. A key gets as many parts as
    its rows would fill shuffle partitions, so all keys together get no more parts than there
    are partitions (plus one per key). With a time column, the first and last time (in
    microseconds) of the key are given too.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = share or partitions
    span = {"_lo": F.min, "_hi": F.max} if time else {}
    counts = df.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_n"), *[f(F.unix_micros(time)).alias(c) for c, f in span.items()]
    )
    total = counts.agg(F.sum("_n")).scalar()
    parts = F.ceil(F.col("_n") * partitions / total).cast("int")
    return counts.filter(F.col("_n") * share > total).select(*on, parts.alias("_parts"), *span)


# Buckets that keys are counted in, at least.
BUCKETS = 1 << 16


def bucket_of(df: DataFrame, on: Sequence[str]) -> Column:
    """The bucket of a row's key. There are many more buckets than shuffle partitions, so few keys
    share one with a heavy key."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*on), F.lit(max(BUCKETS, 16 * partitions))).cast("int")


def heavy_buckets(df: DataFrame, on: Sequence[str], time: str) -> DataFrame | None:
    """The buckets that hold more rows than an average shuffle partition, as `_bucket`, with _parts,
    _lo and _hi as heavy_keys gives them for keys; None if there is none.

    They are counted at once, in one pass over the rows; a task sends a row per bucket at most, and
    the driver gets fewer rows than there are shuffle partitions.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    micros = F.unix_micros(time)
    counts = df.groupBy(bucket_of(df, on).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(micros).alias("_lo"), F.max(micros).alias("_hi")
    )
    # One row per bucket, so a task may hold all of them.
    total = F.sum("_n").over(Window.partitionBy())
    parts = F.ceil(F.col("_n") * partitions / F.col("_total")).cast("int")
    heavy = counts.withColumn("_total", total).filter(F.col("_n") * partitions > F.col("_total"))
    heavy = heavy.select("_bucket", parts.alias("_parts"), "_lo", "_hi")
    found = heavy.collect()
    return spark.createDataFrame(found, heavy.schema) if found else None


def _key_side(heavy: DataFrame, on: Sequence[str]) -> tuple[DataFrame, Column]:
    """The heavy keys as a broadcast side, and the condition that a row has such a key."""
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    # heavy_keys returns fewer rows than there are shuffle partitions, so it may be broadcast.
    return F.broadcast(heavy.withColumnsRenamed({c: f"_h_{c}" for c in on})), match


def _with_parts(df: DataFrame, heavy: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add the part count of the key; null for all but heavy keys. A null key is a key too."""
    side, match = _key_side(heavy, on)
    return df.join(side, match, "left").drop(*[f"_h_{c}" for c in on])


def spread(df: DataFrame, heavy: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add _part: rows of a heavy key go to its parts in turn, all others to part 0."""
    # The part depends on the row and its partition only, so a retried task repeats it; the
    # partition sets copies of the same row apart.
    row = F.xxhash64(*df.columns) + F.spark_partition_id()
    part = F.coalesce(F.pmod(row, F.col("_parts")).cast("int"), F.lit(0))
    return _with_parts(df, heavy, on).withColumn("_part", part).drop("_parts")


def repeat(df: DataFrame, heavy: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add _part: each row of a heavy key once per part of the key, all others once."""
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    return _with_parts(df, heavy, on).withColumn("_part", F.explode(parts)).drop("_parts")


def split_heavy(
    df: DataFrame, heavy: DataFrame, on: Sequence[str], time: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and those of the heavy keys with their time slot, _slot.

    `heavy` comes from heavy_keys with the time column, or from heavy_buckets. A key gets four
    slots per part, evenly over its time.
    """
    side, match = _key_side(heavy, on)
    width = F.ceil((F.col("_hi") - F.col("_lo") + 1) / (F.col("_parts") * 4))
    slot = F.floor((F.unix_micros(time) - F.col("_lo")) / width)
    hot = df.join(side, match).withColumn("_slot", slot).select(*df.columns, "_slot")
    return df.join(side, match, "left_anti"), hot


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    residual: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join a skewed left side to a right side that has one row, or few, per key.

    Rows of heavy keys are spread over parts and the matching right rows repeated for each;
    all other keys join as they are. The result is that of the plain join. `counted` names a
    stored table that has the keys in about the same shares, so that a derived left side is not
    worked out twice; the choice of heavy keys never changes the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot cut up a {how} join")
    heavy = heavy_keys(left if counted is None else counted, on)
    return _join(
        spread(left, heavy, on), repeat(right, heavy, on), [*on, "_part"], how, residual
    ).drop("_part")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    stored: DataFrame | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join facts to a dimension: by broadcast if its size allows, else by skew_join.

    `stored` names the table whose rows the dimension holds one for one, when the dimension
    is derived and its own estimate says little.
    """
    if fits_broadcast(stored if stored is not None else dim):
        return fact.join(F.broadcast(dim), on, how)
    return skew_join(fact, dim, on, how, counted=counted)


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str, residual: Column | None) -> DataFrame:
    if residual is None:
        return left.join(right, on, how)
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = residual
    for c in on:
        cond = cond & (F.col(c) == F.col(f"_r_{c}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])
