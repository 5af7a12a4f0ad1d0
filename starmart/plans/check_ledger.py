"""The declared checks of the star schema (148 column checks) as data.

Table names: staging, order_metrics, customer_metrics, product_metrics,
dim_customers, dim_products, calendar, fact, customer_history,
product_history.
"""

from __future__ import annotations

from starmart.config import SEGMENTS
from starmart.operators.checks import Check

CURRENT = "dbt_valid_to IS NULL"
BOOL_VALUES = ("true", "false")


def _many(kind: str, table: str, cols: tuple[str, ...], **kw) -> list[Check]:
    return [Check(kind, table, c, **kw) for c in cols]


# Tables, columns and severities below must equal the declared checks.
def ledger() -> list[Check]:
    c: list[Check] = []
    # staging
    c += [Check("unique", "staging", "order_item_id")]
    c += _many("not_null", "staging", (
        "order_item_id", "invoice_no", "stock_code", "description", "quantity", "is_return",
        "invoice_date", "invoice_date_only", "unit_price", "customer_id", "country"))
    c += [Check("expression_is_true", "staging", "quantity", expression="quantity != 0"),
          Check("accepted_values", "staging", "is_return", values=BOOL_VALUES),
          Check("not_in_future", "staging", "invoice_date"),
          Check("positive_value", "staging", "unit_price")]
    # customer metrics
    c += [Check("unique", "customer_metrics", "customer_id")]
    c += _many("not_null", "customer_metrics", (
        "customer_id", "total_orders", "total_items", "total_quantity", "total_revenue",
        "gross_revenue", "return_count", "first_order_date", "last_order_date", "recency_days"))
    c += [Check("accepted_values", "customer_metrics", "customer_segment", values=SEGMENTS)]
    # product metrics
    c += _many("unique", "product_metrics", (
        "product_key", "stock_code"))
    c += _many("not_null", "product_metrics", (
        "product_key", "stock_code", "description", "order_count", "total_quantity_sold",
        "total_revenue", "gross_revenue", "return_count", "unique_customers", "min_price",
        "max_price", "avg_price"))
    c += _many("positive_value", "product_metrics", (
        "order_count", "min_price", "max_price", "avg_price"))
    # order metrics
    c += [Check("unique", "order_metrics", "order_key")]
    c += _many("not_null", "order_metrics", (
        "order_key", "invoice_no", "customer_id", "order_date", "line_item_count",
        "unique_items", "total_quantity", "forward_item_count", "total_order_value",
        "forward_order_value", "has_returns"))
    c += _many("positive_value", "order_metrics", (
        "line_item_count", "unique_items"))
    c += [Check("accepted_values", "order_metrics", "has_returns", values=BOOL_VALUES)]
    # current customers
    c += _many("unique", "dim_customers", (
        "customer_key", "customer_id"))
    c += _many("not_null", "dim_customers", (
        "customer_key", "customer_id", "customer_segment", "total_orders", "total_revenue",
        "gross_revenue"))
    c += [Check("accepted_values", "dim_customers", "customer_segment", values=SEGMENTS)]
    # current products
    c += _many("unique", "dim_products", (
        "product_key", "stock_code"))
    c += _many("not_null", "dim_products", (
        "product_key", "stock_code", "description", "order_count", "avg_price"))
    c += _many("positive_value", "dim_products", (
        "order_count", "avg_price"))
    # calendar
    c += _many("unique", "calendar", (
        "date_key", "full_date"))
    c += _many("not_null", "calendar", (
        "date_key", "full_date", "year", "month", "day", "quarter", "day_of_year",
        "week_of_year", "day_name", "month_name", "is_weekend", "is_weekday"))
    c += [Check("relationships", "calendar", "date_key", "warn", to_table="fact",
                to_column="date_key")]
    c += _many("accepted_values", "calendar", (
        "is_weekend", "is_weekday"), values=BOOL_VALUES)
    # fact
    c += [Check("unique", "fact", "order_item_id")]
    c += _many("not_null", "fact", (
        "order_item_id", "customer_key", "product_key"))
    c += [Check("not_null", "fact", "date_key", "warn")]
    c += _many("not_null", "fact", (
        "invoice_date", "invoice_no", "is_return", "quantity", "unit_price", "revenue",
        "country"))
    c += [Check("relationships", "fact", "customer_key", "warn", to_table="customer_history",
                to_column="customer_key"),
          Check("relationships", "fact", "product_key", "warn", to_table="product_history",
                to_column="product_key"),
          Check("relationships", "fact", "date_key", "warn", to_table="calendar",
                to_column="date_key"),
          Check("not_in_future", "fact", "invoice_date"),
          Check("accepted_values", "fact", "is_return", values=BOOL_VALUES),
          Check("positive_value", "fact", "unit_price")]
    # customer history
    c += [Check("unique", "customer_history", "customer_key", where=CURRENT),
          Check("unique", "customer_history", "customer_id", where=CURRENT)]
    c += _many("not_null", "customer_history", (
        "customer_key", "customer_id", "total_orders", "total_items", "total_quantity",
        "total_revenue", "gross_revenue", "return_count", "first_order_date", "last_order_date",
        "recency_days", "customer_segment"))
    c += [Check("relationships", "customer_history", "customer_key", "warn", to_table="fact",
                to_column="customer_key"),
          Check("accepted_values", "customer_history", "customer_segment", values=SEGMENTS)]
    # product history
    c += [Check("unique", "product_history", "product_key", where=CURRENT),
          Check("unique", "product_history", "stock_code", where=CURRENT)]
    c += _many("not_null", "product_history", (
        "product_key", "stock_code", "description", "order_count", "total_quantity_sold",
        "total_revenue", "gross_revenue", "return_count", "unique_customers", "min_price",
        "max_price", "avg_price"))
    c += [Check("relationships", "product_history", "product_key", "warn", to_table="fact",
                to_column="product_key")]
    c += _many("positive_value", "product_history", (
        "min_price", "max_price", "avg_price"))
    return c
