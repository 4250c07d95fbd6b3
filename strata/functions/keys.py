"""Deterministic hash keys.

``surrogate_key(a, b)`` = md5 of the parts cast to text, NULL replaced by a
fixed placeholder, joined with ``-`` (the convention of the widely used dbt
package macro).  ``uuid_key`` re-dashes the 32 hex digits as 8-4-4-4-12.
An md5 digest is always 32 lower-case hex digits, so the dashes are placed by
position (``substring``) instead of a regular expression: same result,
cheaper per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder text for a NULL part and the part separator.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
PART_SEPARATOR = "-"
UUID_GROUPS = (8, 4, 4, 4, 12)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """32-digit md5 hex over the parts."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(PART_SEPARATOR, *parts))


def uuid_format(hex32) -> Column:
    """``'0123…'`` (32 hex) -> ``'01234567-89ab-cdef-0123-456789abcdef'``."""
    h = _c(hex32)
    pieces, pos = [], 1
    for n in UUID_GROUPS:
        pieces.append(F.substring(h, pos, n))
        pos += n
    return F.concat_ws("-", *pieces)


def uuid_key(*cols) -> Column:
    """Surrogate key in UUID text form."""
    return uuid_format(surrogate_key(*cols))


UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
