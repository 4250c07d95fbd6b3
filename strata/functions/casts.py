"""Casts: lenient (``TRY_CAST``), strict, timestamp -> date, NaN -> NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, to: str) -> Column:
    """Bad text -> NULL (``'5.5'`` to INT is NULL, as in Spark SQL)."""
    return _c(c).try_cast(to)


def strict_cast(c, to: str) -> Column:
    """Fails the job on bad input under ANSI mode (the Spark 4 default)."""
    return _c(c).cast(to)


def to_date(c) -> Column:
    """TIMESTAMP -> DATE in the session time zone."""
    return _c(c).cast("date")


def lenient_date(c) -> Column:
    """``CAST(TRY_CAST(text AS TIMESTAMP) AS DATE)``."""
    return _c(c).try_cast("timestamp").cast("date")


def nan_to_null(c) -> Column:
    """A float or double column with NaN as NULL, its type kept."""
    x = _c(c)
    return F.when(~F.isnan(x), x)
