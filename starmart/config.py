"""Pipeline parameters (thresholds, look-back, sentinels)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the source project's behaviour.
MISSING_CUSTOMER = "__missing"          # sentinel for blank customer ids
UNKNOWN_KEY = "-1"                      # fact key when no dimension version matches
UNKNOWN_DATE_KEY = 19000101             # fact date key when the calendar has no row
UNKNOWN_DESCRIPTION = "Unknown"         # product name when the mode is NULL
FIRST_VERSION_FROM = dt.datetime(1900, 1, 1)    # first SCD2 version is valid since
OPEN_VERSION_TO = dt.datetime(9999, 12, 31)     # open SCD2 version is valid until
EMPTY_TARGET_MAX = dt.datetime(1900, 1, 1)      # incremental max() of an empty fact
CALENDAR_FALLBACK = (dt.date(2009, 12, 1), dt.date(2012, 1, 1))  # no staging relation
SEGMENTS = ("high_value", "medium_value", "low_value", "unknown")


@dataclass(frozen=True)
class Thresholds:
    """Customer value-segment thresholds (orders, gross revenue, orders)."""

    high_value_min_orders: int = 10
    high_value_min_revenue: float = 1000.0
    medium_value_min_orders: int = 3


@dataclass(frozen=True)
class PipelineConfig:
    thresholds: Thresholds = field(default_factory=Thresholds)
    lookback_days: int = 3               # late-data window of the incremental fact
    calendar_pad_days: int = 7           # calendar = [min - pad, max + pad)
    surrogate_null_token: str = ""       # text used for NULL parts of a surrogate key
    freshness_warn_hours: int = 24
    freshness_error_hours: int = 48
    row_parity_tolerance: float = 0.001  # fact vs staging row count
    min_load_rows: int = 1000            # ingest gate

    # The columns whose change opens a new version.
    customer_check_cols: tuple[str, ...] = (
        "customer_segment", "total_orders", "total_revenue", "gross_revenue",
        "return_count", "total_items", "total_quantity", "recency_days",
    )
    product_check_cols: tuple[str, ...] = (
        "description", "min_price", "max_price", "avg_price", "order_count",
        "total_revenue",
    )
