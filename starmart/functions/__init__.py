from starmart.functions.casts import safe_decimal, safe_int, safe_timestamp
from starmart.functions.dates import (
    date_key, day_name, iso_weekday, month_diff, month_index, month_name, month_start, ts_lit,
)
from starmart.functions.keys import surrogate_key
from starmart.functions.revenue import forward_value, gross_revenue, line_value, money

__all__ = [
    "safe_decimal", "safe_int", "safe_timestamp", "surrogate_key",
    "date_key", "day_name", "iso_weekday", "month_diff", "month_index", "month_name",
    "month_start", "ts_lit", "forward_value", "gross_revenue", "line_value", "money",
]
