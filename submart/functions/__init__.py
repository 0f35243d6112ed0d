"""Scalar expressions: dates, conditional sums, defaults and key casts."""

from .dates import (day_of, days_before, month_grain, parse_run_date,
                    session_today, window_start)
from .exprs import (UNKNOWN, conditional_sum, key_cast, row_hash, salt_hash,
                    sum_result_type, unknown_default)

__all__ = [
    "UNKNOWN", "conditional_sum", "day_of", "days_before", "key_cast",
    "month_grain", "parse_run_date", "row_hash", "salt_hash", "session_today",
    "sum_result_type", "unknown_default", "window_start",
]
