"""CASE-expression factories: boolean normalisers, guards, bins, flags.

Each keeps the exact NULL behaviour of the warehouse rules it models: a
value outside the listed spellings is NULL, a ladder's ``otherwise`` also
catches NULL, a band (``BETWEEN``) leaves NULL as NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lower_trim


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Accepted spellings per boolean column, compared after
# LOWER(TRIM(x)).  They differ per column on purpose (e.g. is_active has no
# 'y', so a 'Y' becomes NULL).
TRUE_FALSE = (("true",), ("false",))                                        # app_installed, has_complaint, safety_interlock_active
YES_NO_LETTER = (("y",), ("n",))                                            # email_opt_in, sms_opt_in
GROUP_BOOKING = (("1", "true", "yes", "y"), ("0", "false", "no", "n"))      # is_group_booking
ACTIVE = (("1", "true", "yes"), ("0", "false", "no"))                       # is_active
DUPLICATE = (("true", "yes", "1"), ("false", "no", "0"))                    # is_duplicate (wide)


def to_bool(c, true_values: Iterable[str], false_values: Iterable[str]) -> Column:
    """``CASE WHEN lower(trim(c)) IN true THEN TRUE WHEN … IN false THEN FALSE END``."""
    x = lower_trim(c)
    return (F.when(x.isin(list(true_values)), F.lit(True))
             .when(x.isin(list(false_values)), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def to_bool_set(c, sets) -> Column:
    return to_bool(c, sets[0], sets[1])


def in_range_or_null(c, lo: int, hi: int, to: str = "int") -> Column:
    """Strictly cast value when ``lo <= v <= hi``; otherwise NULL."""
    v = _c(c).cast(to)
    return F.when(v.between(lo, hi), v).otherwise(F.lit(None).cast(to))


def bands(c, rules: Sequence[tuple], default=None) -> Column:
    """``CASE WHEN c BETWEEN lo AND hi THEN label … ELSE default END``."""
    x = _c(c)
    out = None
    for lo, hi, label in rules:
        cond = x.between(lo, hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default).cast("string") if default is None else F.lit(default))


_OPS = {
    ">=": lambda x, t: x >= t,
    ">": lambda x, t: x > t,
    "<=": lambda x, t: x <= t,
    "<": lambda x, t: x < t,
}


def ladder(c, rules: Sequence[tuple], default: str, op: str = ">=") -> Column:
    """First matching threshold wins; NULL falls through to ``default``."""
    x = _c(c)
    cmp = _OPS[op]
    out = None
    for threshold, label in rules:
        cond = cmp(x, F.lit(threshold))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def value_map(c, mapping: Mapping, default) -> Column:
    """Exact-match lookup of a small literal map with a default."""
    x = _c(c)
    out = None
    for k, v in mapping.items():
        cond = x == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default))


# The business bins of the warehouse.
TIME_OF_DAY = ((6, 11, "Morning"), (12, 16, "Afternoon"), (17, 20, "Evening"))
TIME_OF_DAY_OTHER = "Off-Hours"
NPS_BANDS = ((9, 10, "Promoter"), (7, 8, "Passive"), (0, 6, "Detractor"))
SCORE_BANDS = ((9, 10, "Excellent"), (7, 8, "Good"), (5, 6, "Average"), (0, 4, "Poor"))
TEMPERATURE_LADDER = ((40, "EXTREME_HEAT"), (30, "HOT"), (20, "WARM"))
TEMPERATURE_OTHER = "COOL"
AIR_QUALITY_LADDER = ((2, "GOOD"), (4, "MODERATE"))
AIR_QUALITY_OTHER = "POOR"
WAIT_LADDER = ((60, "Very High"), (30, "High"), (10, "Medium"))
WAIT_OTHER = "Low"
PRICE_LADDER = ((50, "Low"), (200, "Medium"))
PRICE_OTHER = "High"
CATEGORY_GROUPS = {"F&B": "Food & Beverage", "MERCH": "Merchandise",
                   "ADMISSION": "Tickets", "FASTPASS": "Fast Track"}
CATEGORY_OTHER = "Other"
STAFF_STATUS = ("ACTIVE", "INACTIVE")
SAFETY_STATUS = ("Attention Required", "Normal")
ENTRY_EXIT = {"ENTRY": True, "EXIT": False}


def time_of_day(ts) -> Column:
    """Hour bins; NULL or night hours are 'Off-Hours'."""
    return bands(F.hour(_c(ts)), TIME_OF_DAY, TIME_OF_DAY_OTHER)


def nps_category(c) -> Column:
    return bands(c, NPS_BANDS)


def score_category(c) -> Column:
    return bands(c, SCORE_BANDS)


def temperature_category(c, rules=TEMPERATURE_LADDER, other=TEMPERATURE_OTHER) -> Column:
    return ladder(c, rules, other, ">=")


def air_quality_status(c, rules=AIR_QUALITY_LADDER, other=AIR_QUALITY_OTHER) -> Column:
    return ladder(c, rules, other, "<=")


def wait_time_category(c, rules=WAIT_LADDER, other=WAIT_OTHER) -> Column:
    return ladder(c, rules, other, ">=")


def price_band(c, rules=PRICE_LADDER, other=PRICE_OTHER) -> Column:
    return ladder(c, rules, other, "<")


def category_group(c, mapping=None, other=CATEGORY_OTHER) -> Column:
    return value_map(c, CATEGORY_GROUPS if mapping is None else mapping, other)


def status_label(flag, labels) -> Column:
    """``CASE WHEN flag = TRUE THEN labels[0] ELSE labels[1] END`` (NULL -> second)."""
    return F.when(_c(flag) == F.lit(True), F.lit(labels[0])).otherwise(F.lit(labels[1]))


def any_true(*flags) -> Column:
    """``CASE WHEN a = TRUE OR b = TRUE THEN TRUE ELSE FALSE END``."""
    cond = None
    for f in flags:
        e = _c(f) == F.lit(True)
        cond = e if cond is None else (cond | e)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def three_valued(c, mapping: Mapping) -> Column:
    """Exact-match to booleans, anything else NULL (e.g. ENTRY/EXIT)."""
    x = _c(c)
    out = None
    for k, v in mapping.items():
        cond = x == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(None).cast("boolean"))


def is_not_null_flag(c) -> Column:
    return F.when(_c(c).isNull(), F.lit(False)).otherwise(F.lit(True))


def positive_flag(c) -> Column:
    """``CASE WHEN c > 0 THEN TRUE ELSE FALSE END``."""
    return F.when(_c(c) > 0, F.lit(True)).otherwise(F.lit(False))


def discount_pct(total_charged, discount, gross) -> Column:
    """0 when nothing was charged, else discount / NULLIF(gross, 0) * 100."""
    return (F.when(_c(total_charged) == 0, F.lit(0.0))
             .otherwise((_c(discount) / F.nullif(_c(gross), F.lit(0))) * 100))
