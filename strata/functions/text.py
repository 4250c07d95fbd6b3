"""Text normalisers (trim / case / concat / slices / literal replace).

All are ``Column -> Column`` and stay inside whole-stage codegen.
Spark's ``trim`` removes blanks (U+0020) only, and ``initcap`` lower-cases the
whole string and upper-cases the first letter after a blank, so ``'f&b x-1'``
becomes ``'F&b X-1'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    return F.trim(_c(c))


def initcap_trim(c) -> Column:
    return F.initcap(F.trim(_c(c)))


def upper_trim(c) -> Column:
    return F.upper(F.trim(_c(c)))


def lower_trim(c) -> Column:
    return F.lower(F.trim(_c(c)))


def concat_words(*cols, sep: str = " ") -> Column:
    """``CONCAT(a, ' ', b)``: NULL as soon as one part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c))
    return F.concat(*parts)


def left(c, n: int) -> Column:
    return F.left(_c(c), F.lit(n))


def right(c, n: int) -> Column:
    return F.right(_c(c), F.lit(n))


def replace_literal(c, old: str, new: str) -> Column:
    """Replace every occurrence of ``old`` (no regex)."""
    return F.replace(_c(c), F.lit(old), F.lit(new))


def regexp_groups(c, pattern: str, template: str) -> Column:
    """``REGEXP_REPLACE`` with ``$1``-style group references."""
    return F.regexp_replace(_c(c), pattern, template)


def split_first(c, sep: str = " ") -> Column:
    """Text before the first ``sep`` (whole text when there is none)."""
    return F.try_element_at(F.split(_c(c), _regex_literal(sep), 2), F.lit(1))


def split_rest(c, sep: str = " ") -> Column:
    """Text after the first ``sep``; NULL when there is none."""
    return F.try_element_at(F.split(_c(c), _regex_literal(sep), 2), F.lit(2))


def _regex_literal(s: str) -> str:
    import re
    return re.escape(s)


def null_tokens(c, tokens=("-", "")) -> Column:
    """Trimmed text, or NULL when the trimmed text is one of ``tokens``."""
    t = F.trim(_c(c))
    return F.when(t.isin(list(tokens)), F.lit(None).cast("string")).otherwise(t)


# The text spellings of a missing value that the loader turns
# into NULL (any letter case for 'null').
NULL_TEXTS = ("None", "nan", "NaN")
NULL_TEXT_CASE_INSENSITIVE = "null"


def scrub_null_text(c) -> Column:
    """``'None'``, ``'nan'``, ``'NaN'`` and ``null`` in any case -> NULL."""
    x = _c(c)
    bad = x.isin(list(NULL_TEXTS)) | (F.lower(x) == F.lit(NULL_TEXT_CASE_INSENSITIVE))
    return F.when(bad, F.lit(None).cast("string")).otherwise(x)
