"""Analytic marts on top of the star schema.

Scale notes
* Every mart aggregates the fact first (partial aggregation, so only group
  keys cross the network) and joins the small result to dimensions.
* Windows that order a *whole* series (previous day, same month last year)
  run on already-aggregated daily or monthly rows: their size is bounded by
  the number of calendar days / months in the data, never by order lines.
  Per-entity windows (customer months) are partitioned by the entity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit
from starmart.functions import month_diff, month_start
from starmart.functions.keys import packed_key, unpacked_key
from starmart.operators.grouped import ITEM, KIND, grouped


def _not_return(col: str) -> Column:
    return F.when(~F.col("is_return"), F.col(col)).otherwise(F.lit(0))


def exact_mean_cents(total: Column, n: Column) -> Column:
    """Mean of a cents-valued total over ``n`` items, rounded half up to cents,
    in exact integer arithmetic: floor((200 * total + n) / (2 * n)) cents; NULL if ``n`` is 0."""
    a = (total.cast("decimal(38,2)") * 200).cast("bigint") + n
    d = F.when(n > 0, n * 2)
    cents = F.call_function("div", a - F.pmod(a, d), d).cast("decimal(19,0)")
    return (cents / F.lit(100)).cast("decimal(20,2)").cast("double")


def with_distinct_counts(df: DataFrame, keys: tuple[str, ...], sums: list[Column] | dict[str, tuple[str, Column]],
                         distinct: dict[str, str], hot: DataFrame | None = None) -> DataFrame:
    """``sums`` per ``keys``, and for each name in ``distinct`` the number of
    distinct non-null values of its column.  ``sums``: aggregates, or a name's aggregate
    ("sum", "min" or "max") and what it is taken of.

    Every distinct count is two plain aggregations of its own, brought together
    by key: one ``count_distinct`` per column in a single aggregation would make
    Spark copy each row once per column (Expand) before the shuffle.  With ``hot``, the
    heavy keys of a written ``df`` (``operators.grouped``), each row is dealt once for all."""
    if hot is not None:
        return _dealt_once(df, keys, sums, distinct, hot)
    if isinstance(sums, dict):
        sums = [getattr(F, how)(of).alias(name) for name, (how, of) in sums.items()]
    out = df.groupBy(*keys).agg(*sums)
    for name, col in distinct.items():
        values = df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
        out = out.unionByName(values.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)),
                              allowMissingColumns=True)
    one = [F.max(c).alias(c) for c in out.columns if c not in keys and c not in distinct]
    return out.groupBy(*keys).agg(*one, *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in distinct])


def _dealt_once(df: DataFrame, keys: tuple[str, ...], sums: dict[str, tuple[str, Column]], distinct: dict[str, str], hot: DataFrame) -> DataFrame:
    """``with_distinct_counts`` by one deal of the rows, their hex keys as bytes."""
    hashed = [c for c in dict.fromkeys([*keys, *distinct.values()]) if c in HASHED]

    def carried(rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: packed_key(c) for c in hashed if c in rows.columns})

    of = {name: F.when(F.col(KIND) == 0, F.col(f"__{name}")) for name in sums}
    inner = [getattr(F, how)(of[name]).alias(name) for name, (how, _) in sums.items()]
    outer = [*[getattr(F, how)(name).alias(name) for name, (how, _) in sums.items()],
             *[F.count_if((F.col(KIND) == i) & F.col(ITEM).isNotNull()).alias(name) for i, name in enumerate(distinct)]]
    rows = carried(df).select(*dict.fromkeys([*keys, *distinct.values()]), *[x.alias(f"__{name}") for name, (_, x) in sums.items()])
    items = {f"__item_{c}": F.lower(F.hex(c)) if c in hashed else F.col(c) for c in distinct.values()}
    out = grouped(rows, keys, list(items), inner, outer, items, carried(hot))
    return out.withColumns({c: unpacked_key(c) for c in hashed if c in keys})


# Fixed: the columns that hold hex hashes.
HASHED = ("customer_key", "product_key")


def customer_months(fact: DataFrame) -> DataFrame:
    """The keys of ``churn_features``, a row a line."""
    return fact.select("customer_key", month_start("invoice_date").alias("month"))


# ------------------------------------------------------------------ daily metrics (M1, M2)
def daily_metrics(fact: DataFrame, calendar: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """``hot``: the heavy days (``date_key``) of a written fact."""
    days = calendar.select("date_key", "full_date")
    lines = fact.join(days, "date_key").withColumnRenamed("full_date", "date_day")
    daily = with_distinct_counts(lines, ("date_day",), {
        "order_item_count": ("sum", F.when(F.col("order_item_id").isNotNull(), 1).otherwise(0)),    # the fact's key: no two alike
        "gross": ("sum", _not_return("revenue")),
        "net": ("sum", F.col("revenue")),
        "return_item_count": ("sum", F.when(F.col("is_return"), 1).otherwise(0)),
    }, {"order_count": "invoice_no", "active_customers": "customer_key",
        "active_products": "product_key"}, None if hot is None else hot.join(days, "date_key").select(F.col("full_date").alias("date_day")))
    # one row per calendar day: the ordered window runs over a bounded series
    w = Window.orderBy("date_day")
    return daily.select(
        "date_day",
        F.col("order_item_count").cast("bigint").alias("order_item_count"),
        F.col("order_count").cast("bigint").alias("order_count"),
        F.round("gross", 2).cast("double").alias("gross_revenue"),
        F.round("net", 2).cast("double").alias("net_revenue"),
        F.col("return_item_count").cast("bigint").alias("return_item_count"),
        F.col("active_customers").cast("bigint").alias("active_customers"),
        F.col("active_products").cast("bigint").alias("active_products"),
        F.lag("order_item_count", 1).over(w).cast("bigint").alias("prev_day_orders"),
        F.round(F.lag("gross", 1).over(w), 2).cast("double").alias("prev_day_revenue"),
    )


def daily_metrics_by_country(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    days = calendar.select("date_key", "full_date")
    return fact.join(days, "date_key").groupBy(
        F.col("full_date").alias("date_day"), "country").agg(
        F.count(F.lit(1)).cast("bigint").alias("order_item_count"),
        F.round(F.sum("revenue"), 2).cast("double").alias("net_revenue"),
        F.round(F.sum(_not_return("revenue")), 2).cast("double").alias("gross_revenue"),
    )


# ------------------------------------------------------------------ churn (M3, M4)
def churn_features(fact: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    lines = fact.withColumn("month", month_start("invoice_date"))
    months = with_distinct_counts(lines, ("customer_key", "month"), {
        "quantity_in_month": ("sum", F.col("quantity")),
        "gross": ("sum", _not_return("revenue")),
        "returns_in_month": ("sum", F.when(F.col("is_return"), 1).otherwise(0)),
    }, {"orders_in_month": "invoice_no", "products_in_month": "product_key",
        "countries_in_month": "country"}, hot)
    by_cust = Window.partitionBy("customer_key").orderBy("month")
    prev3 = by_cust.rowsBetween(-3, -1)
    prev_month = F.lag("month", 1).over(by_cust)
    next_month = F.lead("month", 1).over(by_cust)
    churned = (F.when(next_month.isNull(), F.lit(-1))
               .when(month_diff(F.col("month"), next_month) > 3, F.lit(1))
               .otherwise(F.lit(0)))
    return months.select(
        "customer_key", "month",
        F.col("orders_in_month").cast("bigint").alias("orders_in_month"),
        F.col("quantity_in_month").cast("bigint").alias("quantity_in_month"),
        F.col("gross").cast("double").alias("gross_revenue_in_month"),
        F.col("returns_in_month").cast("bigint").alias("returns_in_month"),
        F.col("products_in_month").cast("bigint").alias("products_in_month"),
        F.col("countries_in_month").cast("bigint").alias("countries_in_month"),
        F.sum("orders_in_month").over(prev3).cast("bigint").alias("orders_prev_3m"),
        F.try_divide(F.sum("gross").over(prev3).cast("double"),
                     F.count("gross").over(prev3).cast("double")).alias("avg_revenue_prev_3m"),
        (F.col("gross") - F.lag("gross", 1).over(by_cust)).cast("double")
        .alias("revenue_change_mom"),
        F.when(prev_month.isNotNull(), month_diff(prev_month, F.col("month")))
        .otherwise(F.lit(0)).alias("months_since_prev_order"),
        churned.alias("is_churned"),
        F.when(F.col("gross") > 0,
               F.col("returns_in_month").cast("double") / F.col("gross").cast("double"))
        .otherwise(F.lit(0.0)).alias("return_rate"),
    )


# The columns the churn model reads.
CHURN_FEATURES = ("orders_in_month", "quantity_in_month", "gross_revenue_in_month",
                  "returns_in_month", "products_in_month", "countries_in_month",
                  "orders_prev_3m", "avg_revenue_prev_3m", "revenue_change_mom",
                  "months_since_prev_order", "return_rate")


def churn_candidates(features: DataFrame, customers: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Latest feature month per customer before the as-of month, with the
    current customer attributes (score columns left empty for the model)."""
    from starmart.operators.dedup import keep_first

    current_month = ts_lit(as_of)
    latest = keep_first(features.filter(F.col("month") < F.date_trunc("month", current_month)
                                        .cast("timestamp_ntz")),
                        ["customer_key"], [F.col("month").desc()])
    d = customers.select("customer_key", "customer_id", "customer_segment", "recency_days",
                         "total_orders", "total_revenue", "return_count")
    j = latest.join(d, "customer_key", "left")
    return j.select(
        "customer_key", "customer_id", "customer_segment",
        F.col("month").alias("last_active_month"),
        "orders_in_month", "gross_revenue_in_month", "orders_prev_3m", "avg_revenue_prev_3m",
        "revenue_change_mom", "months_since_prev_order", "return_rate", "recency_days",
        "total_orders", "total_revenue", "return_count",
        F.lit(None).cast("float").alias("churn_probability"),
        F.lit(None).cast("string").alias("churn_risk_tier"),
    )


def risk_tier(p: Column) -> Column:
    """Right-closed bins: (-, .2] low, (.2, .5] medium, (.5, .8] high, (.8, -] critical."""
    return (F.when(p.isNull(), F.lit("unknown"))
            .when(p <= 0.2, F.lit("low")).when(p <= 0.5, F.lit("medium"))
            .when(p <= 0.8, F.lit("high")).otherwise(F.lit("critical")))


# ------------------------------------------------------------------ demand and forecasts
def product_demand_series(fact: DataFrame, product_history: DataFrame,
                          min_quantity: int = 100) -> DataFrame:
    current = product_history.filter(F.col("dbt_valid_to").isNull()) \
        .select("product_key", "stock_code", "description")
    # summed by key first: the join sees one row a product and month, not every line
    by_key = fact.groupBy(packed_key("product_key").alias("product_key"), month_start("invoice_date").alias("ds")).agg(
        F.sum(F.when(~F.col("is_return"), F.col("quantity")).otherwise(F.lit(0))).alias("y"))
    by_key = by_key.withColumn("product_key", unpacked_key("product_key"))
    return by_key.join(current, "product_key").groupBy("stock_code", "description", "ds").agg(F.sum("y").alias("y")).filter(F.col("y") > min_quantity).select(
        F.concat(F.col("stock_code"), F.lit(" - "), F.col("description")).alias("unique_id"),
        "ds", F.col("y").cast("bigint").alias("y"))


def daily_series(daily: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Long (unique_id, ds, y) series from daily metrics, before the as-of day."""
    d = daily.filter(F.col("date_day") < F.lit(as_of.date()))
    return d.select("date_day", F.explode(F.array(
        F.struct(F.lit("revenue").alias("unique_id"), F.col("gross_revenue").alias("y")),
        F.struct(F.lit("active_customers").alias("unique_id"),
                 F.col("active_customers").cast("double").alias("y")),
        F.struct(F.lit("return_items").alias("unique_id"),
                 F.col("return_item_count").cast("double").alias("y")),
    )).alias("s")).select("s.unique_id", F.col("date_day").alias("ds"), "s.y")


Z80 = 1.2815515655446004   # fixed: standard normal quantiles for 80 % / 95 % bands
Z95 = 1.959963984540054


EPOCH = dt.date(1970, 1, 1)


def seasonal_forecast(series: DataFrame, horizon: int = 30, period: int = 7,
                      step: str = "day") -> DataFrame:
    """Seasonal-naive forecast per series with residual-stddev bands.

    ``step`` is the distance of two points, "day" or "month" (then ``ds`` is
    any time of the month; the forecast's is its first day).  yhat of a point
    is the latest value at a whole number m of periods before it: a missing
    point falls back to the season before; NULL if no season has it.  sigma =
    sample stddev of y(t) - y(t - period) over the history; the band half-width
    grows with sqrt(m).  Everything is joined and aggregated by series id."""
    if step == "day":
        at, back = F.datediff("ds", F.lit(EPOCH)), F.date_add(F.lit(EPOCH), F.col("t"))
    elif step == "month":
        at = (F.year("ds") - EPOCH.year) * 12 + F.month("ds") - 1
        back = F.add_months(F.lit(EPOCH), F.col("t"))
    else:
        raise ValueError(f"step must be 'day' or 'month', not {step!r}")
    phase = F.pmod("t", F.lit(period)).alias("phase")
    s = series.select("unique_id", at.alias("t"), F.col("y").cast("double").alias("y"))
    lagged = s.select("unique_id", (F.col("t") + period).alias("t"), F.col("y").alias("y_lag"))
    sigma = s.join(lagged, ["unique_id", "t"]).groupBy("unique_id").agg(
        F.stddev_samp(F.col("y") - F.col("y_lag")).alias("sigma"))
    source = s.groupBy("unique_id", phase).agg(
        F.max_by("y", "t").alias("yhat"), F.max("t").alias("src_t"))
    steps = s.groupBy("unique_id").agg(F.max("t").alias("last_t")).select(
        "unique_id", F.explode(F.sequence(F.col("last_t") + 1, F.col("last_t") + horizon)).alias("t"))
    f = steps.select("*", phase).join(source, ["unique_id", "phase"], "left") \
        .join(sigma, "unique_id", "left")
    yhat = F.col("yhat")
    half = F.col("sigma") * F.sqrt((F.col("t") - F.col("src_t")) / F.lit(float(period)))
    return f.select(
        "unique_id", back.alias("ds"), F.lit("SeasonalNaive").alias("model_name"),
        F.round(yhat, 2).alias("yhat"),
        F.round(yhat - Z80 * half, 2).alias("yhat_lower_80"),
        F.round(yhat + Z80 * half, 2).alias("yhat_upper_80"),
        F.round(yhat - Z95 * half, 2).alias("yhat_lower_95"),
        F.round(yhat + Z95 * half, 2).alias("yhat_upper_95"),
    )


def forecast_vs_actual(daily: DataFrame, forecasts: DataFrame, as_of: dt.datetime,
                       days_back: int = 90) -> DataFrame:
    today = F.lit(as_of.date())
    actuals = daily.filter(F.col("date_day") >= F.date_sub(today, days_back)).select(
        "date_day", F.col("gross_revenue").alias("actual_revenue"))
    fc = forecasts.filter(F.col("unique_id") == "revenue").select(
        F.col("ds").alias("date_day"), F.col("yhat").alias("forecasted_revenue"),
        F.col("yhat_lower_95").alias("forecast_lower"),
        F.col("yhat_upper_95").alias("forecast_upper"))
    j = actuals.join(fc, "date_day", "full_outer")
    return j.select(
        "date_day", "actual_revenue", "forecasted_revenue", "forecast_lower", "forecast_upper",
        F.round((F.col("actual_revenue") - F.col("forecasted_revenue"))
                / F.nullif(F.col("forecasted_revenue"), F.lit(0.0)) * 100, 2)
        .alias("pct_deviation"),
        F.when(F.col("actual_revenue").isNull() | (F.col("date_day") >= today),
               F.lit("forecast")).otherwise(F.lit("actual")).alias("data_type"),
    ).orderBy(F.col("date_day").desc())


# ------------------------------------------------------------------ exposures (M10-M13)
def customer_360(fact: DataFrame, customers: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    lines = fact.withColumn("month", month_start("invoice_date"))
    per = with_distinct_counts(lines, ("customer_key",), {
        "lines": ("sum", F.lit(1)),
        "net": ("sum", F.col("revenue")),
        "return_lines": ("sum", F.when(F.col("is_return"), 1).otherwise(0)),
        "ret_value": ("sum", F.when(F.col("is_return"), F.col("revenue")).otherwise(F.lit(0))),
        "first_invoice": ("min", F.col("invoice_date")),
        "last_invoice": ("max", F.col("invoice_date")),
    }, {"orders": "invoice_no", "active_months": "month"}, hot)
    c = customers.select("customer_key", "customer_id", "customer_segment")
    j = c.join(per, "customer_key", "left")
    return j.select(
        "customer_key", "customer_id", "customer_segment",
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
        F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
        F.round(F.coalesce("net", F.lit(0)), 2).cast("double").alias("net_revenue"),
        F.coalesce("return_lines", F.lit(0)).cast("bigint").alias("return_lines"),
        F.round(F.coalesce("ret_value", F.lit(0)), 2).cast("double").alias("returned_value"),
        "first_invoice", "last_invoice",
        F.coalesce("active_months", F.lit(0)).cast("bigint").alias("active_months"),
    )


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    per = fact.groupBy("product_key", month_start("invoice_date").alias("month")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("qty"),
        F.sum("revenue").alias("net"),
        F.sum(F.when(F.col("is_return"), 1).otherwise(0)).alias("return_lines"),
    )
    p = products.select("product_key", "stock_code", "description", "min_price", "max_price")
    j = per.join(p, "product_key", "left")
    return j.select(
        "product_key", "stock_code", "description", "month",
        F.col("lines").cast("bigint").alias("lines"),
        F.col("qty").cast("bigint").alias("quantity"),
        F.round("net", 2).cast("double").alias("net_revenue"),
        F.col("return_lines").cast("bigint").alias("return_lines"),
        (F.col("return_lines").cast("double") / F.col("lines").cast("double")).alias("return_rate"),
        "min_price", "max_price",
    )


def revenue_overview(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly totals on the calendar's month spine with year-over-year change."""
    months = calendar.select(F.make_date("year", "month", F.lit(1)).alias("month")).distinct()
    per = fact.groupBy(F.to_date(month_start("invoice_date")).alias("month")).agg(
        F.sum("revenue").alias("net"),
        F.sum(_not_return("revenue")).alias("gross"),
        F.count(F.lit(1)).alias("lines"),
    )
    j = months.join(per, "month", "left")
    net = F.coalesce("net", F.lit(0))
    w = Window.orderBy("month")          # one row per calendar month (bounded)
    prev = F.lag(net, 12).over(w)
    return j.select(
        "month",
        F.round(net, 2).cast("double").alias("net_revenue"),
        F.round(F.coalesce("gross", F.lit(0)), 2).cast("double").alias("gross_revenue"),
        F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
        F.round(prev, 2).cast("double").alias("net_revenue_last_year"),
        F.round((net - prev).cast("double") / F.nullif(prev.cast("double"), F.lit(0.0)) * 100, 2)
        .alias("yoy_pct"),
    )


def order_value_by_month(orders: DataFrame) -> DataFrame:
    per = orders.groupBy(F.to_date(month_start("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum(F.col("total_order_value").cast("decimal(38,2)")).alias("value"),
        F.sum("line_item_count").alias("lines"),
    )
    return per.select(
        "month",
        F.col("orders").cast("bigint").alias("orders"),
        F.col("customers").cast("bigint").alias("customers"),
        exact_mean_cents(F.col("value"), F.col("orders")).alias("avg_order_value"),
        (F.col("lines").cast("double") / F.col("orders").cast("double")).alias("avg_basket_size"),
        (F.col("orders").cast("double") / F.col("customers").cast("double"))
        .alias("orders_per_customer"),
    )
