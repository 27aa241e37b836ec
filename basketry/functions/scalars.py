"""Small column expressions used across the jobs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """A wire amount as an exact decimal, so that sums do not depend on row order."""
    return _col(c).try_cast("decimal(18,2)")


def normalized(c) -> Column:
    return F.lower(F.trim(_col(c)))


def table_of_topic(c) -> Column:
    """The part of a topic name after its last dot; empty for a name without one."""
    name = _col(c)
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", -1)).when(name.isNotNull(), "")


def ratio(part: Column, whole: Column) -> Column:
    """Division as double; null where the divisor is zero or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """A rate in percent to two places, worked out in decimals so that halves round up."""
    exact = F.try_divide((part * 100).cast("decimal(30,2)"), whole.cast("decimal(30,2)"))
    return F.round(exact, 2).cast("double")


def stock_after(stock, delta) -> Column:
    """Stock after a change; never below zero."""
    return F.greatest(F.lit(0), _col(stock) + _col(delta))
