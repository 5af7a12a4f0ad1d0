"""Staging: typed, filtered, de-duplicated order lines with a surrogate key.

Plan shape: scan -> filter on the raw text (pushed to the scan) -> project
(safe casts) -> filter price -> one shuffle on the four grain columns for the
top-1 dedup -> project.  No other exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import MISSING_CUSTOMER, PipelineConfig
from starmart.functions import safe_decimal, safe_int, safe_timestamp, surrogate_key
from starmart.operators.dedup import keep_first

GRAIN = ("invoice_no", "stock_code", "invoice_date", "customer_id")

STAGING_COLUMNS = ("order_item_id", "invoice_no", "stock_code", "description", "quantity",
                   "is_return", "invoice_date", "invoice_date_only", "unit_price",
                   "customer_id", "country")


def _text(name: str):
    return F.trim(F.col(name).cast("string"))


def typed_order_lines(raw: DataFrame) -> DataFrame:
    """Raw-row filter (on the untrimmed text), then trim and safe casts."""
    present = (
        F.col("invoice_no").isNotNull() & (F.col("invoice_no") != "")
        & F.col("stock_code").isNotNull() & (F.col("stock_code") != "")
        & F.col("invoice_date").isNotNull() & F.col("unit_price").isNotNull()
    )
    return raw.filter(present).select(
        _text("invoice_no").alias("invoice_no"),
        _text("stock_code").alias("stock_code"),
        _text("description").alias("description"),
        safe_int("quantity").alias("quantity"),
        safe_timestamp("invoice_date").alias("invoice_date"),
        safe_decimal("unit_price", 10, 2).alias("unit_price"),
        F.coalesce(F.nullif(_text("customer_id"), F.lit("")),
                   F.lit(MISSING_CUSTOMER)).alias("customer_id"),
        _text("country").alias("country"),
    ).filter(F.col("unit_price") > 0)


def line_order() -> list[Column]:
    """Longest description, then alphabetical description, country, quantity,
    price (the last two make the pick deterministic)."""
    return [
        F.length("description").desc_nulls_last(),
        F.col("description").asc_nulls_last(),
        F.col("country").asc_nulls_last(),
        F.col("quantity").asc_nulls_last(),
        F.col("unit_price").asc_nulls_last(),
    ]


def dedup_order_lines(typed: DataFrame) -> DataFrame:
    """One row per grain, the first in the line order."""
    return keep_first(typed, list(GRAIN), line_order())


def stored_lines(raw: DataFrame) -> DataFrame:
    """What has to be stored of the cleaned lines: the rest (``with_line_keys``) follows from it, and the key, a hash that no
    encoding shortens, is half of a line's bytes."""
    return dedup_order_lines(typed_order_lines(raw)).select(
        "invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country")


def with_line_keys(stored: DataFrame, cfg: PipelineConfig | None = None, *extra: str) -> DataFrame:
    cfg = cfg or PipelineConfig()
    return stored.select(
        surrogate_key(*GRAIN, null_token=cfg.surrogate_null_token).alias("order_item_id"),
        "invoice_no", "stock_code", "description", "quantity",
        (F.col("quantity") < 0).alias("is_return"),
        "invoice_date",
        F.to_date("invoice_date").alias("invoice_date_only"),
        "unit_price", "customer_id", "country", *extra,
    )


def clean_order_lines(raw: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    return with_line_keys(stored_lines(raw), cfg)
