"""Calendar functions and the date spine."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def month_name(c) -> Column:
    return F.date_format(_c(c), "MMMM")


def date_key(c) -> Column:
    """Smart key ``yyyyMMdd`` as INT."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def us_date_text(c) -> Column:
    return F.date_format(_c(c), "MM/dd/yyyy")


def whole_years_between(start, end) -> Column:
    """Whole years elapsed (``DATEDIFF(year, start, end)``)."""
    return F.timestamp_diff("YEAR", _c(start), _c(end))


def days_between(start, end) -> Column:
    """``DATEDIFF(day, start, end)``."""
    return F.datediff(_c(end), _c(start))


def as_of_date(as_of=None) -> Column:
    """``CURRENT_DATE()`` or an injected date (for reproducible runs)."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)[:10]).cast("date")


def as_of_timestamp(as_of=None) -> Column:
    """``CURRENT_TIMESTAMP()`` or an injected instant."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(str(as_of)).cast("timestamp")


# Calendar range of the park warehouse and its weekend (Friday, Saturday).
DEFAULT_SPINE_START = "2025-01-01"
DEFAULT_SPINE_END = "2026-12-31"
WEEKEND_DAYS = ("Friday", "Saturday")


def date_spine(spark: SparkSession, start: str = DEFAULT_SPINE_START,
               end: str = DEFAULT_SPINE_END, name: str = "dt") -> DataFrame:
    """One row per day, ``EXPLODE(SEQUENCE(start, end, INTERVAL 1 DAY))``.

    The row count is fixed by the two parameters (days between them), not by
    any data, so the result is safe to broadcast; ``spine_days`` returns the
    bound.
    """
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias(name))


def spine_days(start: str = DEFAULT_SPINE_START, end: str = DEFAULT_SPINE_END) -> int:
    a = _dt.date.fromisoformat(start)
    b = _dt.date.fromisoformat(end)
    return (b - a).days + 1


def calendar_columns(dt="dt", weekend=WEEKEND_DAYS) -> list[Column]:
    """The calendar attributes of the date dimension, in table order."""
    d = _c(dt)
    return [
        date_key(d).alias("date_key"),
        us_date_text(d).alias("date_iso"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        day_name(d).alias("weekday_name"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.when(day_name(d).isin(list(weekend)), F.lit(True)).otherwise(F.lit(False))
         .alias("is_weekend"),
    ]
