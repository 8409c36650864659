"""Column functions: columns in, columns out, all of them built-in expressions."""

from tallyward.functions.bands import alert_above, alert_below, threshold_band
from tallyward.functions.dates import (
    date_parts,
    date_text,
    days_between,
    month_key,
    month_label,
    parse_date,
    parse_datetime,
)
from tallyward.functions.logic import (
    all_true,
    count_done,
    filled,
    first_match,
    is_in,
    is_true,
    not_null_and_prefix,
    recode,
)
from tallyward.functions.numbers import percent, percent_text, ratio, round_half_even, thousands
from tallyward.functions.text import (
    as_text,
    contains_any_case,
    cut_ending,
    cut_first,
    leading_integer,
    remove_first,
    replace_first,
)

__all__ = [
    "alert_above", "alert_below", "all_true", "as_text", "contains_any_case", "count_done",
    "cut_ending", "cut_first", "date_parts", "date_text", "days_between", "filled", "first_match", "is_in", "is_true",
    "leading_integer", "month_key", "month_label", "not_null_and_prefix", "parse_date",
    "parse_datetime", "percent", "percent_text", "ratio", "recode", "remove_first",
    "replace_first", "round_half_even", "thousands", "threshold_band",
]
