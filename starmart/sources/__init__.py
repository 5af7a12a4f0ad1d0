from starmart.sources.csv_orders import (
    ValidationResult, raw_load_profile, read_order_csv, validate_order_csv,
)
from starmart.sources.driver_tables import raw_order_lines, table
from starmart.sources.freshness import freshness

__all__ = ["ValidationResult", "raw_load_profile", "read_order_csv", "validate_order_csv",
           "raw_order_lines", "table", "freshness"]
