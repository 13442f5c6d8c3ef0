"""Relational operators: quality flags, cleaning, daily aggregates, the date spine."""

from daybook.operators.ads import ads_clean, check_ads, flag_ads, interval_samples
from daybook.operators.daily import (
    ads_daily,
    ads_from_sums,
    ads_sums,
    merged_ad_sums,
    merged_order_sums,
    orders_daily,
    orders_from_sums,
    orders_sums,
)
from daybook.operators.orders import check_orders, flag_orders, orders_clean, unknown_statuses
from daybook.operators.quality import (
    DQReport,
    accepted,
    dq_report,
    enforce_threshold,
    flag_known,
    flag_missing,
    flag_repeats,
    known_keys,
    quality_summary,
    rejected,
    rejection_counts,
    repeated_keys,
)
from daybook.operators.spine import date_bounds, date_spine

__all__ = [
    "DQReport",
    "accepted",
    "ads_clean",
    "ads_daily",
    "ads_from_sums",
    "ads_sums",
    "check_ads",
    "check_orders",
    "date_bounds",
    "date_spine",
    "dq_report",
    "enforce_threshold",
    "flag_ads",
    "flag_known",
    "flag_missing",
    "flag_orders",
    "flag_repeats",
    "interval_samples",
    "known_keys",
    "merged_ad_sums",
    "merged_order_sums",
    "orders_clean",
    "orders_daily",
    "orders_from_sums",
    "orders_sums",
    "quality_summary",
    "rejected",
    "rejection_counts",
    "repeated_keys",
    "unknown_statuses",
]
