"""Sales fact: point-in-time joins to both histories and the calendar, plus
the incremental rules (look-back, delete+insert on the key, schema guard).

Plan shape (large scale): staging is shuffled once on customer_id for the
customer range join and once on stock_code for the product range join
Spark's size check decides how the calendar is joined.  Heavy keys are
salted (see ``temporal_join``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit
from pyspark.sql.types import StructType

from starmart.config import UNKNOWN_DATE_KEY, UNKNOWN_KEY
from starmart.functions import money, surrogate_key
from starmart.operators.dedup import keep_first
from starmart.operators.staging import GRAIN
from starmart.operators.temporal_join import join_as_of, version_ranges

FACT_COLUMNS = ("order_item_id", "customer_key", "product_key", "date_key", "invoice_date",
                "invoice_no", "is_return", "quantity", "unit_price", "revenue", "country")

LINE = ("invoice_no", "stock_code", "invoice_date")    # with the customer, the grain of the lines
PACKED = ("invoice_no", "stock_code", "customer_id", "quantity", "unit_price", "invoice_date", "country")


def sales_fact(lines: DataFrame, customer_history: DataFrame, product_history: DataFrame,
               calendar: DataFrame, hot_customers: DataFrame | None = None,
               hot_products: DataFrame | None = None) -> DataFrame:
    s = keyed_lines(lines.select("order_item_id", "invoice_no", "stock_code", "customer_id", "quantity",
                                 "is_return", "unit_price", "invoice_date", "invoice_date_only", "country"),
                    customer_history, product_history, calendar, F.col("invoice_date_only"), hot_customers, hot_products)
    return s.select(
        "order_item_id",
        F.coalesce("customer_key", F.lit(UNKNOWN_KEY)).alias("customer_key"),
        F.coalesce("product_key", F.lit(UNKNOWN_KEY)).alias("product_key"),
        F.coalesce("date_key", F.lit(UNKNOWN_DATE_KEY)).alias("date_key"),
        "invoice_date", "invoice_no", "is_return", "quantity", "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("revenue"),
        "country",
    )


def keyed_lines(lines: DataFrame, customer_history: DataFrame, product_history: DataFrame, calendar: DataFrame, day: Column,
                hot_customers: DataFrame | None = None, hot_products: DataFrame | None = None) -> DataFrame:
    """Lines with the keys of the versions valid at their time and of their ``day``; null where there is none."""
    cust = version_ranges(customer_history, "customer_id", ["customer_key"])
    prod = version_ranges(product_history, "stock_code", ["product_key"])
    s = join_as_of(lines, cust, "customer_id", "invoice_date", ["customer_key"], hot_customers, LINE)
    s = join_as_of(s, prod, "stock_code", "invoice_date", ["product_key"], hot_products, LINE)
    days = calendar.select("date_key", F.col("full_date").alias("__day"))  # one bad date makes it long: no forced broadcast
    return s.join(days, day == days["__day"], "left").drop("__day")


def packed_fact(lines: DataFrame, customer_history: DataFrame, product_history: DataFrame, calendar: DataFrame,
                hot_customers: DataFrame | None = None, hot_products: DataFrame | None = None) -> DataFrame:
    """What ``unpacked_fact`` makes the fact rows from: every shuffle carries the two keys as 16 bytes, not as 32 hex digits,
    and neither the lines' own key nor what follows from other columns."""
    def packed(history: DataFrame, key: str) -> DataFrame:
        return history.withColumn(key, F.unhex(key))

    s = keyed_lines(lines.select(*PACKED), packed(customer_history, "customer_key"), packed(product_history, "product_key"), calendar,
                    F.to_date("invoice_date"), hot_customers, hot_products)
    return s.withColumn("date_key", F.coalesce("date_key", F.lit(UNKNOWN_DATE_KEY)))


def unpacked_fact(rows: DataFrame, null_token: str = "", *extra: str) -> DataFrame:
    """The rows of ``sales_fact`` (and columns ``extra``) from those of ``packed_fact``."""
    def text(key: str) -> Column:
        return F.coalesce(F.lower(F.hex(key)), F.lit(UNKNOWN_KEY)).alias(key)

    return rows.select(
        surrogate_key(*GRAIN, null_token=null_token).alias("order_item_id"), text("customer_key"), text("product_key"), "date_key",
        "invoice_date", "invoice_no", (F.col("quantity") < 0).alias("is_return"), "quantity", "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("revenue"), "country", *extra)


def fact_output(fact: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Query output convention: money columns as DOUBLE."""
    return fact.select(*[money(F.col(c)).alias(c) if c in ("unit_price", "revenue") else c
                         for c in FACT_COLUMNS], *extra)


def lookback_filter(lines: DataFrame, target_max: dt.datetime | None,
                    days: int = 3) -> DataFrame:
    """Rows the incremental run accepts: ``invoice_date >= max(target) - days``
    (inclusive).  The bound is a literal, so a month-partitioned staging table
    is pruned at the scan."""
    floor = (target_max or dt.datetime(1900, 1, 1)) - dt.timedelta(days=days)
    cond = F.col("invoice_date") >= ts_lit(floor)
    if "invoice_month" in lines.columns:  # month-partitioned staging: prune at the scan
        cond = (F.col("invoice_month") >= floor.year * 100 + floor.month) & cond
    return lines.filter(cond)


def target_max_ts(target: DataFrame | None, ts_col: str = "invoice_date") -> dt.datetime | None:
    """Scalar max of the target (one value to the driver, read from one column)."""
    if target is None:
        return None
    return target.agg(F.max(ts_col)).collect()[0][0]


def keep_latest(df: DataFrame, key: str, ts_col: str = "invoice_date",
                seq_col: str | None = None) -> DataFrame:
    """One row per key: latest ``ts_col``, then highest ``seq_col`` (batch id)."""
    order = [F.col(ts_col).desc_nulls_last()]
    if seq_col:
        order.append(F.col(seq_col).desc_nulls_last())
    return keep_first(df, [key], order)


def upsert_by_key(target: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """Delete target rows whose key is in the batch, then insert the batch."""
    if target is None:
        return batch
    keys = batch.select(key).distinct()
    return target.join(keys, key, "left_anti").unionByName(batch)


class SchemaDrift(ValueError):
    pass


def assert_same_schema(target: StructType | DataFrame, batch: StructType | DataFrame) -> None:
    """Refuse a batch whose columns (names, order-insensitive, and types) differ."""
    t = target.schema if isinstance(target, DataFrame) else target
    b = batch.schema if isinstance(batch, DataFrame) else batch
    tn = {f.name: f.dataType.simpleString() for f in t.fields}
    bn = {f.name: f.dataType.simpleString() for f in b.fields}
    if tn != bn:
        missing = sorted(set(tn) - set(bn))
        extra = sorted(set(bn) - set(tn))
        retyped = sorted(c for c in set(tn) & set(bn) if tn[c] != bn[c])
        raise SchemaDrift(f"schema change refused: missing={missing} extra={extra} "
                          f"retyped={retyped}")
