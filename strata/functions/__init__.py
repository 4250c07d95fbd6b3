"""Column factories (``Column -> Column``), all built-in Spark expressions."""

from .cases import (any_true, bands, category_group, discount_pct, in_range_or_null,
                    is_not_null_flag, ladder, nps_category, positive_flag, price_band,
                    score_category, status_label, temperature_category, air_quality_status,
                    three_valued, time_of_day, to_bool, to_bool_set, value_map,
                    wait_time_category)
from .casts import lenient_date, nan_to_null, strict_cast, to_date, try_cast
from .dates import (as_of_date, as_of_timestamp, calendar_columns, date_key, date_spine,
                    day_name, days_between, month_name, spine_days, us_date_text,
                    whole_years_between)
from .keys import surrogate_key, uuid_format, uuid_key, UUID_PATTERN
from .text import (concat_words, initcap_trim, left, lower_trim, null_tokens, regexp_groups,
                   replace_literal, right, scrub_null_text, split_first, split_rest, trimmed,
                   upper_trim)

__all__ = [n for n in dir() if not n.startswith("_")]
