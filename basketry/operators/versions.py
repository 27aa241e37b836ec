"""Version histories: slowly changing dimensions and the lookup of the version valid at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.operators.ranking import top_k_per_group
from basketry.operators.skew import bucket_of, fits_broadcast, heavy_buckets, heavy_keys, skew_join, split_heavy


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    time: str,
    attributes: Sequence[str],
    tie_break: Sequence[str] = (),
    deleted: str = "is_deleted",
    counted: DataFrame | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Change rows to versions: attributes, effective_from, effective_to, is_current.

    Of several changes of a key at the same instant the last by `tie_break` counts. A change
    that alters no attribute opens no version. A delete closes the open version; a later
    change opens a new one.

    All steps look at neighbours in time, over one shuffle by key. A heavy key would be too
    much for one task, so its rows are cut into time slots, and what a slot must know of the
    slots around it comes from a table of one row per slot. Heavy keys are looked for at once, in
    one pass over `changes`, or over `counted` if that is cheaper to read: rows with the time and
    the columns `by`, which `changes` has too and which tell the keys apart.
    """
    by = keys if by is None else by
    heavy = heavy_buckets(changes if counted is None else counted, by, time)
    ties = [*tie_break, deleted, *attributes]
    columns = [*keys, time, *dict.fromkeys(ties)]
    if heavy is None:
        rows, group = changes.select(*columns), [*keys]
    else:
        light, hot = split_heavy(
            changes.select(*columns, bucket_of(changes, by).alias("_bucket")), heavy, ["_bucket"], time
        )
        # Copies of a heavy key at one instant are dropped where they are read.
        hot = top_k_per_group(
            hot.select(*columns, "_slot"), [*keys, time], [F.col(c).desc_nulls_last() for c in ties], 1, "_rn"
        ).drop("_rn")
        hot = hot.withColumn("_hot", F.lit(True))
        light = light.select(*columns).withColumn("_hot", F.lit(False)).withColumn("_slot", F.lit(0).cast("bigint"))
        rows, group = light.unionByName(hot), [*keys, "_hot", "_slot"]

    in_order = [F.col(c).asc_nulls_first() for c in (time, *ties)]
    inside = Window.partitionBy(*group).orderBy(*in_order)
    following = F.lead(time).over(inside)
    last_of_instant = rows.withColumn("_next", following).filter(
        F.col("_next").isNull() | (F.col("_next") != F.col(time))
    ).drop("_next")

    state = F.struct(F.col(deleted), *[F.col(c) for c in attributes])
    before = _neighbour(last_of_instant, None if heavy is None else hot, keys, group, time, in_order, state, forward=False)
    gone_before = F.col("_seen").isNull() | F.col(f"_seen.{deleted}")
    same = F.lit(True)
    for c in attributes:
        same = same & F.col(c).eqNullSafe(F.col(f"_seen.{c}"))
    changed = F.when(F.col(deleted), ~gone_before).otherwise(gone_before | ~same)
    kept = before.filter(changed).drop("_seen")

    hot_kept = None if heavy is None else kept.filter("_hot")
    closed = _neighbour(kept, hot_kept, keys, group, time, in_order, F.col(time), forward=True)
    return closed.filter(~F.col(deleted)).select(
        *keys,
        *attributes,
        F.col(time).alias("effective_from"),
        F.col("_seen").alias("effective_to"),
        F.col("_seen").isNull().alias("is_current"),
    )


def _neighbour(
    rows: DataFrame, hot: DataFrame | None, keys: Sequence[str], group: list[str], time: str,
    in_order: list[Column], value: Column, forward: bool,
) -> DataFrame:
    """Add _seen: `value` of the next or previous row of the key; `hot` are the slotted rows, if any."""
    shift, pick = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    # The same sort serves every step, whichever way it looks.
    inside = Window.partitionBy(*group).orderBy(*in_order)
    here = rows.withColumn("_inside", shift(F.struct(value.alias("v"))).over(inside))
    if hot is None:
        return here.withColumn("_seen", F.col("_inside")["v"]).drop("_inside")
    edges = hot.groupBy(*group).agg(pick(F.struct(value.alias("v")), F.col(time)).alias("_edge"))
    across = Window.partitionBy(*keys, "_hot").orderBy("_slot")
    edges = edges.withColumn("_across", shift("_edge").over(across)).drop("_edge")
    joined = here.join(edges, group, "left")
    return joined.withColumn("_seen", F.coalesce("_inside", "_across")["v"]).drop("_inside", "_across")


# A broadcast lookup compares a fact with every version of its key; above this it merges.
FEW_VERSIONS = 100


def as_of_lookup(
    fact: DataFrame, dim: DataFrame, on: list[str], time: str, columns: Sequence[str],
    stored: DataFrame | None = None, counted: DataFrame | None = None,
    versions_per_key: int | None = None, times: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the version that was valid at the time of the fact; null if none was.

    A dimension is broadcast if it is small and no key has many versions, which is counted
    unless `versions_per_key` tells. If it tells that a key has one version, there is nothing to
    look for in time, and a join balanced by key does. Otherwise facts and versions are merged in
    order of time, one pass per key, so a key with many versions costs no comparison of each with each.
    A version without key or start is never valid, and a fact without key or time finds none.
    `stored` and `counted` are as in lookup_join and skew_join, `times` as in merge_as_of.
    """
    versions = dim.select(
        *on, *columns, F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to")
    ).dropna(subset=[*on, "_from"])
    small = fits_broadcast(stored if stored is not None else dim)
    if small and versions_per_key is None:
        counts = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
        versions_per_key = counts.agg(F.max("n")).first()[0] or 0
    valid = (F.col(time) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(time) < F.col("_to")))
    if not small and versions_per_key == 1:
        return skew_join(fact, versions, on, "left", valid, counted).drop("_from", "_to")
    if small and versions_per_key <= FEW_VERSIONS:
        side = versions.withColumnsRenamed({c: f"_r_{c}" for c in on})
        for c in on:
            valid = valid & (F.col(c) == F.col(f"_r_{c}"))
        joined = fact.join(F.broadcast(side), valid, "left")
        return joined.drop("_from", "_to", *[f"_r_{c}" for c in on])
    return merge_as_of(fact, versions, on, time, columns, counted, times)


def merge_as_of(
    fact: DataFrame, versions: DataFrame, on: list[str], time: str, columns: Sequence[str],
    counted: DataFrame | None = None, times: DataFrame | None = None,
) -> DataFrame:
    """The sorted form of as_of_lookup; versions hold _from and _to and do not overlap.

    A heavy key is cut into slots of about equally many rows, facts and versions together, at
    quantiles of their times, so a burst fills as many slots as its rows ask for. A slot knows of
    the versions before it by one row, the last of them; none is repeated. Facts of one instant
    that fill several slots are dealt to all of these. `times` names a stored table that has
    the keys and times of facts and versions together in about the same shares; the slots are then
    taken from it, and neither side is worked out more than once.
    """
    given = fact.columns
    facts = fact.withColumn("_fact", F.struct(*given)).select(*on, F.col(time).alias("_at"), F.lit(1).alias("_kind"), "_fact")
    known = versions.select(
        *on, F.col("_from").alias("_at"), F.lit(0).alias("_kind"), F.struct(*columns, "_to").alias("_version")
    )
    if times is None:
        asked = (fact if counted is None or time not in counted.columns else counted).select(*on, F.col(time).alias("_at"))
        at = asked.unionByName(versions.select(*on, F.col("_from").alias("_at")))
    else:
        at = times.select(*on, F.col(time).alias("_at"))
    bounds = _quantiles(at, on)
    slotted = [_slotted(rows, bounds, on) for rows in (facts, known)]
    both = slotted[0].unionByName(slotted[1], allowMissingColumns=True)
    rows = both.unionByName(_carried(slotted[1], bounds, on), allowMissingColumns=True)
    # A version counts from its first instant on, so it sorts before a fact at that instant; what
    # is carried in sorts before all.
    so_far = (
        Window.partitionBy(*on, "_slot").orderBy("_kind_first", "_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = rows.withColumn("_kind_first", F.when(F.col("_kind") == -1, 0).otherwise(1))
    seen = ranked.withColumn("_seen", F.last("_version", ignorenulls=True).over(so_far))
    valid = F.col("_seen._to").isNull() | (F.col("_at") < F.col("_seen._to"))
    return seen.filter(F.col("_kind") == 1).select(
        "_fact.*", *[F.when(valid, F.col(f"_seen.{c}")).alias(c) for c in columns]
    )


# Quantiles that are taken of a heavy key; a key is cut into as many slots at most.
_CUTS = 256


def _quantiles(times: DataFrame, on: list[str]) -> DataFrame:
    """The heavy keys, as _h_ columns, with the ascending times at which their slots begin.

    There are fewer heavy keys than shuffle partitions, and each has at most _CUTS times.
    """
    heavy = heavy_keys(times, on).withColumnsRenamed({c: f"_h_{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    own = times.join(F.broadcast(heavy), match).groupBy(*[f"_h_{c}" for c in on], "_parts")
    marks = own.agg(F.percentile_approx(F.unix_micros("_at"), [i / _CUTS for i in range(1, _CUTS)], 10 * _CUTS).alias("_marks"))
    step = F.greatest(F.lit(1), F.floor(F.lit(_CUTS) / F.col("_parts")))
    picked = F.filter("_marks", lambda _, i: (i + 1) % step == 0)
    return marks.select(*[f"_h_{c}" for c in on], picked.alias("_bounds"))


def _slotted(rows: DataFrame, bounds: DataFrame, on: list[str]) -> DataFrame:
    """Add _slot: how many bounds lie before the time. A fact at a bound that occurs several times
    may go to any of their slots, as the version of that instant lies in the first of them."""
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    joined = rows.join(F.broadcast(bounds), match, "left")
    at = F.unix_micros("_at")
    before = F.size(F.filter("_bounds", lambda b: b < at))
    same = F.size(F.filter("_bounds", lambda b: b == at))
    # By the row itself, so that a task that runs again deals it to the same slot.
    spread = F.pmod(F.xxhash64("_fact"), same + 1) if "_fact" in rows.columns else F.lit(0)
    slot = F.when(F.col("_bounds").isNotNull(), before + spread).otherwise(0).cast("int")
    return joined.withColumn("_slot", slot).drop("_bounds", *[f"_h_{c}" for c in on])


def _carried(known: DataFrame, bounds: DataFrame, on: list[str]) -> DataFrame:
    """For each slot of a heavy key but the first the last version of all slots before it."""
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    slots = bounds.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.size("_bounds"))))
    slots = slots.select(*[F.col(f"_h_{c}").alias(c) for c in on], "_slot")
    hot = known.join(F.broadcast(bounds), match).groupBy(*on, "_slot").agg(F.max_by("_version", "_at").alias("_last"))
    renamed = hot.withColumnsRenamed({c: f"_r_{c}" for c in (*on, "_slot")})
    cond = F.col("_slot") == F.col("_r__slot")
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    each = slots.join(renamed, cond, "left")
    before = Window.partitionBy(*on).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = each.withColumn("_version", F.last("_last", ignorenulls=True).over(before))
    return carried.filter(F.col("_version").isNotNull()).select(
        *on, F.lit(None).cast("timestamp").alias("_at"), F.lit(-1).alias("_kind"), "_version", "_slot"
    )
