from stratum.functions.calendar import calendar_columns, date_id
from stratum.functions.columns import (
    compose_timestamp,
    empty_to_null,
    filled_count,
    label,
    month_start_label,
    non_negative,
    null_safe_sum,
    rate_per_100,
    row_fingerprint,
    sentinel_to_null,
    surrogate_key,
    try_cast,
)

__all__ = [
    "calendar_columns", "date_id", "compose_timestamp", "empty_to_null", "filled_count",
    "label", "month_start_label", "non_negative", "null_safe_sum", "rate_per_100",
    "row_fingerprint", "sentinel_to_null", "surrogate_key", "try_cast",
]
