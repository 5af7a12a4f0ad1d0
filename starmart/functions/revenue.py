"""Revenue expressions shared by the metric layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def line_value(quantity: Column | str = "quantity",
               price: Column | str = "unit_price") -> Column:
    return _c(quantity) * _c(price)


def forward_value(quantity: Column | str = "quantity",
                  price: Column | str = "unit_price",
                  is_return: Column | str = "is_return") -> Column:
    """Line value when the line is not a return, else 0.

    A NULL return flag yields 0 (``NOT NULL`` is not true)."""
    return F.when(~_c(is_return), line_value(quantity, price)).otherwise(F.lit(0))


def gross_revenue(quantity: Column | str = "quantity",
                  price: Column | str = "unit_price",
                  is_return: Column | str = "is_return") -> Column:
    """Aggregate: sum of non-return line values."""
    return F.sum(forward_value(quantity, price, is_return))


def money(col: Column) -> Column:
    """Money output convention: round to cents, expose as DOUBLE."""
    return F.round(col, 2).cast("double")
