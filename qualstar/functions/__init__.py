"""Column-level functions (native Spark expressions only)."""

from .dates import (as_timestamp, can_canonicalise, compare_dates_ge, days_between, days_since,
                    days_between_within, is_strict_iso_date, parse_flexible, strip_ws)
from .text import contains_any, digits_only, is_blank, occupation_category, postal_prefix

__all__ = [
    "as_timestamp", "can_canonicalise", "compare_dates_ge", "days_between", "days_since", "days_between_within",
    "is_strict_iso_date", "parse_flexible", "strip_ws", "contains_any", "digits_only", "is_blank",
    "occupation_category", "postal_prefix",
]
