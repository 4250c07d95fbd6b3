"""Aggregations used by dimensions and checks (partial + final by Spark)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_AGGS = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "first": F.first}


def dim_from_groups(df: DataFrame, keys: Sequence[str], attrs: Mapping[str, str]) -> DataFrame:
    """One row per ``keys`` with each attribute aggregated independently.

    ``{"gate_location": "max", "zone_code": "max"}`` picks the two maxima on
    their own, so the pair need not occur in any single input row.
    """
    return df.groupBy(*keys).agg(*[_AGGS[f](F.col(c)).alias(c) for c, f in attrs.items()])


def key_pool(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """The distinct keys of a column, without NULL (partial + final aggregate)."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(name or column)).distinct()


def null_counts(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """One row: NULL count per column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(prefix + c) for c in cols])


def ratio_pct(num, den, digits: int = 2) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), digits)`` as DOUBLE."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.round(n.cast("double") * 100.0 / F.nullif(d.cast("double"), F.lit(0.0)), digits)
