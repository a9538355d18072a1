from shiftledger.functions.attendance import early_departure, late_arrival, overtime
from shiftledger.functions.cleaning import (
    is_junk_id,
    parse_date,
    parse_flag,
    parse_number,
    parse_timestamp,
    strip_text,
    without_null_tokens,
)
from shiftledger.functions.measures import hour_units, percentage, rounded_ratio

__all__ = [
    "early_departure", "hour_units", "is_junk_id", "late_arrival", "overtime", "parse_date",
    "parse_flag", "parse_number", "parse_timestamp", "percentage", "rounded_ratio",
    "strip_text", "without_null_tokens",
]
