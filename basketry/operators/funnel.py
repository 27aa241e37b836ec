"""Ordered funnels: how far each user gets through a row of steps within a span of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.scalars import percent


def step_progress(events: DataFrame, user: str, time: str, steps: Sequence[Column], seconds: int) -> DataFrame:
    """Events that advance a user to a step, with _user, _at, step and started_at.

    A chain begins with an event of the first step and advances with an event of the next step at
    the same time or later, as long as its time is at most `seconds` after the beginning. Of several
    chains that a user has at one step the one begun last is kept, as it lasts the longest; so the
    state is one beginning per step, a running maximum of those that the step before handed on.

    What matters to an event lies at most a span before it. Time is cut into slots one span long;
    each slot is folded on its own with the events of the slot before it as its carried state, so
    a busy user is split by time and no event is taken more than twice. An event is of the first
    step that it fits. Events without user or time belong to nobody.
    """
    span = seconds * 1_000_000
    number = F.coalesce(*[F.when(s, i) for i, s in enumerate(steps, 1)])
    micros = F.unix_micros(time)
    slot = F.floor(micros / F.lit(span))
    known = events.select(F.col(user).alias("_user"), F.col(time).alias("_at"), micros.alias("_t"), number.alias("step"), slot.alias("_own"))
    known = known.filter(F.col("_user").isNotNull() & F.col("_t").isNotNull() & F.col("step").isNotNull())
    # Nothing follows the last step, so it is no state of the next slot.
    carried = F.when(F.col("step") < len(steps), F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
    rows = known.withColumn("_slot", F.explode(carried))
    so_far = (
        Window.partitionBy("_user", "_slot").orderBy("_t")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begun = F.when(F.col("step") == 1, F.col("_t"))
    rows = rows.withColumn("_c1", begun)
    for i in range(2, len(steps) + 1):
        rows = rows.withColumn(f"_b{i}", F.max(f"_c{i - 1}").over(so_far))
        inside = (F.col("step") == i) & (F.col("_t") - F.col(f"_b{i}") <= span)
        rows = rows.withColumn(f"_c{i}", F.when(inside, F.col(f"_b{i}")))
    started = F.coalesce(*[F.col(f"_c{i}") for i in range(1, len(steps) + 1)])
    return rows.filter((F.col("_slot") == F.col("_own")) & started.isNotNull()).select(
        "_user", "_at", "step", F.timestamp_micros(started).alias("started_at")
    )


def funnel_steps(
    events: DataFrame, user: str, time: str, steps: dict[str, Column], seconds: int
) -> DataFrame:
    """One row per step: step, name, users that reached it, their share of the step before and of
    the first one in percent (null where that is empty)."""
    reached = step_progress(events, user, time, list(steps.values()), seconds)
    furthest = reached.groupBy("_user").agg(F.max("step").alias("step"))
    counts = furthest.groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(n) for n in steps])
    every = events.sparkSession.range(1, len(steps) + 1).select(F.col("id").cast("int").alias("step"))
    by_step = Window.orderBy("step")  # one row per step
    at_least = F.sum(F.coalesce("n", F.lit(0))).over(by_step.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    named = every.join(counts, "step", "left").select(
        "step", F.element_at(names, F.col("step")).alias("name"), at_least.alias("users")
    )
    before, first = F.lag("users").over(by_step), F.first("users").over(by_step)
    return named.withColumns({
        "from_previous_pct": percent(F.col("users"), F.nullif(before, F.lit(0))),
        "from_first_pct": percent(F.col("users"), F.nullif(first, F.lit(0))),
    })
