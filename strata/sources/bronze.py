"""Bronze ingest: tagged multi-source union and landing clean-up helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import replace_literal, scrub_null_text as _scrub_col, split_first, split_rest


def tag_union(sources: Mapping[str, DataFrame], tag_col: str = "source_region",
              by_name: bool = True) -> DataFrame:
    """``SELECT *, '<tag>' AS tag_col FROM a UNION ALL …`` over all sources.

    ``by_name=True`` matches columns by name (a source with a different
    column order is still right); ``False`` is the positional SQL union.
    A filter on the tag later removes whole branches at planning time.
    """
    out = None
    for tag, df in sources.items():
        t = df.withColumn(tag_col, F.lit(tag))
        if out is None:
            out = t
        elif by_name:
            out = out.unionByName(t)
        else:
            out = out.union(t)
    return out


def scrub_null_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null-like text (``None``, ``nan``, ``NaN``, ``null`` any case) -> NULL in ``cols``
    (default: every string column), in one projection."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = set(string_cols if cols is None else cols) & string_cols
    return df.select(*[_scrub_col(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def rekey_tenant(df: DataFrame, old: str, new: str,
                 overrides: Mapping[str, object] | None = None) -> DataFrame:
    """Copy of a tenant's rows for another tenant.

    Every string column has the literal ``old`` replaced by ``new``; text
    ``'None'``/``'nan'``/``'NaN'`` becomes NULL; ``overrides`` set columns to
    constants (e.g. ``{"park_code": "AQ"}``).
    """
    overrides = dict(overrides or {})
    cols = []
    for f in df.schema.fields:
        if f.name in overrides:
            cols.append(F.lit(overrides[f.name]).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            r = replace_literal(F.col(f.name), old, new)
            cols.append(F.when(r.isin("None", "nan", "NaN"), F.lit(None).cast("string"))
                         .otherwise(r).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Fixed value: VAT rate of the sales amounts.
VAT_RATE = 0.15


def with_sales_amounts(df: DataFrame, price: str = "unit_price", qty: str = "quantity",
                       discount: str = "discount_amount", vat_rate: float = VAT_RATE) -> DataFrame:
    """gross = round(q * price, 2); net = gross - discount; vat = round(net * rate, 2);
    total = net + vat."""
    gross = F.round(F.col(qty) * F.col(price), 2)
    return (df.withColumn("gross_amount", gross)
              .withColumn("net_amount", F.col("gross_amount") - F.col(discount))
              .withColumn("vat_amount", F.round(F.col("net_amount") * F.lit(vat_rate), 2))
              .withColumn("total_charged", F.col("net_amount") + F.col("vat_amount")))


def split_name(df: DataFrame, full: str = "full_name", first: str = "first_name",
               last: str = "last_name") -> DataFrame:
    """First word and the rest of a full name."""
    return (df.withColumn(first, split_first(F.col(full)))
              .withColumn(last, split_rest(F.col(full))))


def card_number(c, old: str = "CUST", new: str = "LC") -> Column:
    """Loyalty card number derived from the customer id."""
    return replace_literal(c, old, new)
