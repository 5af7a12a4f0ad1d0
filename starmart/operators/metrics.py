"""Order, customer and product metrics.

Each is a group of lines by its key with distinct counts of other columns: one
deal of the lines, see ``operators.grouped`` (``hot`` there says which keys are
heavy; without it, every level is an ordinary aggregate with a map-side step).

The metrics as of several cuts of the data come from one pass: ``cuts`` is how
many there are, and column ``CUT`` of a line the number of the first one it
belongs to.  A line belongs to all later ones as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.config import MISSING_CUSTOMER, UNKNOWN_DESCRIPTION, PipelineConfig, Thresholds
from starmart.functions import forward_value, line_value, money, surrogate_key
from starmart.operators.dedup import keep_first
from starmart.operators.grouped import ITEM, KIND, grouped
from starmart.session import written

CUT = "__cut"


def _steps(cuts: int) -> list[Column]:
    """Whether a line belongs to each cut (to the one there is, if there are none)."""
    return [F.col(CUT) <= i for i in range(cuts)] or [F.lit(True)]


def _cut(*names: str, cuts: int = 0) -> list[str]:
    return [*names, *([CUT] if cuts else [])]


def _returned() -> dict[str, Column]:
    return {"is_return": F.col("quantity") < 0}


def _by_cut(rows: DataFrame, key: str, values: Sequence[str], there: str, cuts: int) -> DataFrame:
    """One row a key and cut, for the cuts in which ``there`` is above 0, from columns numbered by cut."""
    if not cuts:
        return rows.select(key, *[F.col(f"{c}_0").alias(c) for c in values])
    each = F.array(*[F.struct(F.lit(i).alias(CUT), *[F.col(f"{c}_{i}").alias(c) for c in values]) for i in range(cuts)])
    return rows.select(key, F.explode(each).alias("__c")).select("__c.*", key).where(F.col(there) > 0)


def order_metrics(lines: DataFrame, cfg: PipelineConfig | None = None, hot: DataFrame | None = None) -> DataFrame:
    cfg = cfg or PipelineConfig()
    sums = {"lines": F.count(F.lit(1)), "qty": F.sum("quantity"), "net": F.sum(line_value()), "gross": F.sum(forward_value()),
            "forward_lines": F.sum(F.when(F.col("is_return"), 0).otherwise(1))}
    orders = grouped(
        lines.select("invoice_no", "customer_id", "stock_code", "invoice_date", "quantity", "unit_price"),
        ["invoice_no", "customer_id"], ["stock_code"],
        [F.min("invoice_date").alias("first_ts"), F.bool_or("is_return").alias("any_return"), *[v.alias(c) for c, v in sums.items()]],
        [F.min("first_ts").alias("first_ts"), F.count(F.lit(1)).alias("unique_items"), F.bool_or("any_return").alias("any_return"),
         *[F.sum(c).alias(c) for c in sums]], _returned(), hot)
    return orders.select(
        surrogate_key("invoice_no", "customer_id",
                      null_token=cfg.surrogate_null_token).alias("order_key"),
        "invoice_no", "customer_id",
        F.col("first_ts").alias("order_date"),
        F.col("lines").cast("bigint").alias("line_item_count"),
        F.col("unique_items").cast("bigint").alias("unique_items"),
        F.col("qty").cast("bigint").alias("total_quantity"),
        F.col("forward_lines").cast("bigint").alias("forward_item_count"),
        money(F.col("net")).alias("total_order_value"),
        money(F.col("gross")).alias("forward_order_value"),
        F.col("any_return").alias("has_returns"),
    )


def segment(customer_id, orders, gross, t: Thresholds):
    """Value segment; compares the *unrounded* gross revenue."""
    return (
        F.when(customer_id == MISSING_CUSTOMER, F.lit("unknown"))
        .when((orders >= t.high_value_min_orders) & (gross >= t.high_value_min_revenue),
              F.lit("high_value"))
        .when(orders >= t.medium_value_min_orders, F.lit("medium_value"))
        .otherwise(F.lit("low_value"))
    )


def customer_metrics(lines: DataFrame, cfg: PipelineConfig | None = None,
                     hot: DataFrame | None = None, cuts: int = 0) -> DataFrame:
    cfg = cfg or PipelineConfig()
    inner, outer = [], []
    for i, there in enumerate(_steps(cuts)):
        sums = {"lines": F.count(F.when(there, 1)), "qty": F.sum(F.when(there, F.col("quantity"))),
                "net": F.sum(F.when(there, line_value())), "gross": F.sum(F.when(there, forward_value())),
                "returns": F.count(F.when(there & F.col("is_return"), 1))}
        inner += [F.min(F.when(there, F.col("invoice_date"))).alias(f"first_{i}"),
                  F.max(F.when(there, F.col("invoice_date"))).alias(f"last_{i}"), *[v.alias(f"{c}_{i}") for c, v in sums.items()]]
        outer += [F.count_if(F.col(f"lines_{i}") > 0).alias(f"orders_{i}"), F.min(f"first_{i}").alias(f"first_{i}"),
                  F.max(f"last_{i}").alias(f"last_{i}"), *[F.sum(f"{c}_{i}").alias(f"{c}_{i}") for c in sums]]
    # written: read for the newest date as well
    per_customer = written(grouped(
        lines.select(*_cut("customer_id", "invoice_no", "invoice_date", "quantity", "unit_price", cuts=cuts)),
        ["customer_id"], ["invoice_no"], inner, outer, _returned(), hot), "customer-sums")
    newest = F.array(*[per_customer.agg(F.max(f"last_{i}")).scalar() for i in range(max(1, cuts))])
    c = _by_cut(per_customer, "customer_id", ("orders", "lines", "qty", "net", "gross", "returns", "first", "last"), "orders", cuts)
    c = c.withColumn("max_date", newest[F.col(CUT) if cuts else 0]).withColumnsRenamed({
        "orders": "total_orders", "lines": "total_items", "qty": "total_quantity", "returns": "return_count",
        "first": "first_order_date", "last": "last_order_date"})
    by = _cut(cuts=cuts)
    return c.select(
        *by,
        surrogate_key("customer_id", null_token=cfg.surrogate_null_token).alias("customer_key"),
        "customer_id",
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("total_items").cast("bigint").alias("total_items"),
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        money(F.col("net")).alias("total_revenue"),
        money(F.col("gross")).alias("gross_revenue"),
        F.col("return_count").cast("bigint").alias("return_count"),
        "first_order_date", "last_order_date",
        F.datediff(F.col("max_date"), F.col("last_order_date")).alias("recency_days"),
        segment(F.col("customer_id"), F.col("total_orders"), F.col("gross"),
                cfg.thresholds).alias("customer_segment"),
    )


def best_description(lines: DataFrame) -> DataFrame:
    """Most frequent description per product; ties -> alphabetical; a NULL
    description may win (shown as 'Unknown' downstream)."""
    counts = lines.groupBy("stock_code", "description") \
        .agg(F.count(F.lit(1)).alias("cnt"))
    best = keep_first(counts, ["stock_code"],
                      [F.col("cnt").desc(), F.col("description").asc_nulls_last()])
    return best.select("stock_code", "description")


def product_metrics(lines: DataFrame, cfg: PipelineConfig | None = None,
                    hot: DataFrame | None = None, cuts: int = 0) -> DataFrame:
    cfg = cfg or PipelineConfig()
    items = ["invoice_no", "customer_id", "description"]
    kind, n, inner, outer = F.col(KIND), "lines", [], []
    for i, there in enumerate(_steps(cuts)):
        counted = there & (kind == 0)                       # sums: each line under its invoice
        sums = {"qty": F.sum(F.when(counted, F.col("quantity"))), "net": F.sum(F.when(counted, line_value())),
                "gross": F.sum(F.when(counted, forward_value())), "returns": F.count(F.when(counted & F.col("is_return"), 1)),
                "price_sum": F.sum(F.when(counted, F.col("unit_price"))), "price_n": F.count(F.when(counted, F.col("unit_price")))}
        inner += [F.count(F.when(there, 1)).alias(f"{n}_{i}"), F.min(F.when(counted, F.col("unit_price"))).alias(f"price_min_{i}"),
                  F.max(F.when(counted, F.col("unit_price"))).alias(f"price_max_{i}"), *[v.alias(f"{c}_{i}") for c, v in sums.items()]]
        held = F.col(f"{n}_{i}") > 0
        # the most frequent description, the first of the alphabet among such; a missing one comes last
        name = F.min(F.when(held & (kind == 2), F.struct(-F.col(f"{n}_{i}"), F.col(ITEM).isNull(), F.col(ITEM).alias("description"))))
        outer += [F.count_if(held & (kind == 0)).alias(f"order_count_{i}"), F.count_if(held & (kind == 1)).alias(f"unique_customers_{i}"),
                  name["description"].alias(f"description_{i}"), F.min(f"price_min_{i}").alias(f"min_price_{i}"),
                  F.max(f"price_max_{i}").alias(f"max_price_{i}"), *[F.sum(f"{c}_{i}").alias(f"{c}_{i}") for c in sums]]
    per_product = grouped(lines.select(*_cut("stock_code", *items, "quantity", "unit_price", cuts=cuts)),
                          ["stock_code"], items, inner, outer, _returned(), hot)
    p = _by_cut(per_product, "stock_code", ("order_count", "unique_customers", "description", "min_price", "max_price", "qty", "net", "gross",
                                            "returns", "price_sum", "price_n"), "order_count", cuts).withColumnsRenamed(
        {"qty": "total_quantity_sold", "returns": "return_count"})
    by = _cut(cuts=cuts)
    # exact mean of the line prices, rounded half up to cents
    avg_cents = F.expr("(price_sum * 200 + price_n) div (price_n * 2)")
    return p.select(
        *by,
        surrogate_key("stock_code", null_token=cfg.surrogate_null_token).alias("product_key"),
        "stock_code",
        F.coalesce(F.col("description"), F.lit(UNKNOWN_DESCRIPTION)).alias("description"),
        F.col("order_count").cast("bigint").alias("order_count"),
        F.col("total_quantity_sold").cast("bigint").alias("total_quantity_sold"),
        money(F.col("net")).alias("total_revenue"),
        money(F.col("gross")).alias("gross_revenue"),
        F.col("return_count").cast("bigint").alias("return_count"),
        F.col("unique_customers").cast("bigint").alias("unique_customers"),
        money(F.col("min_price")).alias("min_price"),
        money(F.col("max_price")).alias("max_price"),
        (avg_cents / F.lit(100)).cast("decimal(20,2)").cast("double").alias("avg_price"),
    )
