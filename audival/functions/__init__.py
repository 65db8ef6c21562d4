from audival.functions.columns import (
    classify_login_state, consent_status, month_from_dash, month_from_yearmonth,
    normalise_device, safe_div, user_status_of,
)
from audival.functions.filters import dimension_filter, parse_filter
from audival.functions.typed import parse_typed_value

__all__ = [
    "classify_login_state", "consent_status", "month_from_dash", "month_from_yearmonth",
    "normalise_device", "safe_div", "user_status_of", "dimension_filter", "parse_filter",
    "parse_typed_value",
]
