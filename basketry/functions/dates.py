"""Date keys, date parts, recency filters and partition predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def with_date_parts(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns(
        {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}
    )


def date_key(date) -> Column:
    """A date as the integer yyyyMMdd."""
    date = F.col(date) if isinstance(date, str) else date
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def since_minutes(time: str, as_of, minutes: int) -> Column:
    """Whether a time is at most some minutes before as_of."""
    return F.col(time) >= as_column(as_of) - F.make_dt_interval(mins=F.lit(minutes))


def since_days(date: str | Column, as_of, days: int) -> Column:
    date = F.col(date) if isinstance(date, str) else date
    return date >= F.date_sub(F.to_date(as_column(as_of)), days)


def between_days(start: dt.date, end: dt.date) -> Column:
    """A predicate on year/month/day, so that whole partitions of [start, end] are skipped.

    A filter on event_time cannot prune folders; this one can.
    """
    def after(d):
        return (F.col("year") > d.year) | (
            (F.col("year") == d.year)
            & ((F.col("month") > d.month) | ((F.col("month") == d.month) & (F.col("day") >= d.day)))
        )

    return after(start) & ~after(end + dt.timedelta(days=1))


def calendar_columns(date: str) -> dict[str, Column]:
    """Calendar attributes of a date column."""
    d = F.col(date)
    return {
        "date_key": date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(span: str) -> int:
    """The seconds of a setting such as "30 minutes"."""
    number, unit = span.split()
    return int(number) * _SECONDS[unit.removesuffix("s")]
