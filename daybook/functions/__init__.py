"""Column expressions: text in, typed value or null out. No Python runs per row."""

from daybook.functions.currency import to_reporting_currency
from daybook.functions.measures import (
    add_parts,
    exact_sum,
    guarded_ratio,
    parts_total,
    roas_band,
    roas_band_label,
    round_half_even,
    sum_parts,
)
from daybook.functions.moments import parse_date, parse_timestamp, reporting_date
from daybook.functions.numbers import parse_counter, parse_money
from daybook.functions.text import campaign_label, is_blank, status_key, stripped

__all__ = [
    "add_parts",
    "campaign_label",
    "exact_sum",
    "guarded_ratio",
    "is_blank",
    "parse_counter",
    "parse_date",
    "parse_money",
    "parse_timestamp",
    "parts_total",
    "reporting_date",
    "roas_band",
    "roas_band_label",
    "round_half_even",
    "status_key",
    "stripped",
    "sum_parts",
    "to_reporting_currency",
]
