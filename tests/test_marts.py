import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starmart.operators import marts
from starmart.operators.checks import daily_row_sigma

FACT = ("order_item_id string, customer_key string, product_key string, date_key int, "
        "invoice_date timestamp_ntz, invoice_no string, is_return boolean, quantity int, "
        "unit_price decimal(10,2), revenue decimal(21,2), country string")


def _fact_row(i, cust, day, revenue="10.00", is_return=False):
    return (f"o{i}", cust, "p1", int(day.strftime("%Y%m%d")), dt.datetime.combine(day, dt.time(9)),
            f"inv{i}", is_return, -1 if is_return else 1, Decimal("10.00"), Decimal(revenue), "UK")


def test_churn_labels_and_month_gaps(spark):
    months = [dt.date(2020, 1, 5), dt.date(2020, 2, 5), dt.date(2020, 5, 5), dt.date(2020, 9, 5)]
    rows = [_fact_row(i, "c1", d) for i, d in enumerate(months)]
    rows.append(_fact_row(9, "c1", dt.date(2020, 2, 6), "-4.00", is_return=True))
    fact = spark.createDataFrame(rows, FACT)
    got = sorted(marts.churn_features(fact).collect(), key=lambda r: r.month)
    assert [r.months_since_prev_order for r in got] == [0, 1, 3, 4]
    assert [r.is_churned for r in got] == [0, 0, 1, -1]      # gap > 3 churns; last unknown
    feb = got[1]
    assert feb.returns_in_month == 1 and feb.gross_revenue_in_month == 10.0
    assert feb.return_rate == 0.1 and feb.revenue_change_mom == 0.0
    assert got[3].orders_prev_3m == 4 and got[3].avg_revenue_prev_3m == 10.0


def test_daily_sigma_flat_series_and_spike(spark):
    start = dt.date(2020, 1, 1)
    rows = []
    i = 0
    for d in range(40):
        day = start + dt.timedelta(days=d)
        n = 50 if d == 39 else 2               # flat history, spike on the last day
        for _ in range(n):
            rows.append(_fact_row(i, "c", day))
            i += 1
    fact = spark.createDataFrame(rows, FACT)
    as_of = dt.datetime(2020, 2, 10)
    got = {r.day: r for r in daily_row_sigma(fact, "invoice_date", as_of).collect()}
    last = got[start + dt.timedelta(days=39)]
    assert last.rolling_std == 0.0 and last.z_score is None and last.is_anomaly is False
    rows2 = rows + [_fact_row(10_000 + k, "c", start + dt.timedelta(days=30)) for k in range(3)]
    got2 = {r.day: r for r in daily_row_sigma(spark.createDataFrame(rows2, FACT), "invoice_date",
                                               as_of).collect()}
    assert got2[start + dt.timedelta(days=39)].is_anomaly is True


def test_forecast_vs_actual_pairs(spark):
    daily = spark.createDataFrame(
        [(dt.date(2020, 1, 1), 100.0), (dt.date(2020, 1, 2), 50.0), (dt.date(2020, 1, 3), 70.0)],
        "date_day date, gross_revenue double")
    fc = spark.createDataFrame(
        [("revenue", dt.date(2020, 1, 1), 80.0, 70.0, 90.0),
         ("revenue", dt.date(2020, 1, 3), 0.0, -1.0, 1.0),
         ("revenue", dt.date(2020, 1, 4), 60.0, 50.0, 70.0),
         ("other", dt.date(2020, 1, 2), 1.0, 0.0, 2.0)],
        "unique_id string, ds date, yhat double, yhat_lower_95 double, yhat_upper_95 double")
    out = marts.forecast_vs_actual(daily, fc, dt.datetime(2020, 1, 4))
    got = {r.date_day: r for r in out.collect()}
    assert got[dt.date(2020, 1, 1)].pct_deviation == 25.0               # both
    assert got[dt.date(2020, 1, 2)].forecasted_revenue is None         # actual only
    assert got[dt.date(2020, 1, 3)].pct_deviation is None              # forecast 0
    assert got[dt.date(2020, 1, 4)].data_type == "forecast"            # forecast only
    assert [r.date_day for r in out.collect()] == sorted(got, reverse=True)


def test_seasonal_naive_repeats_last_week(spark):
    start = dt.date(2020, 1, 6)
    series = spark.createDataFrame(
        [("s", start + dt.timedelta(days=d), float(d % 7)) for d in range(21)],
        "unique_id string, ds date, y double")
    fc = marts.seasonal_forecast(series, horizon=10).orderBy("ds").collect()
    assert [r.yhat for r in fc] == [float(d % 7) for d in range(21, 31)]
    assert all(r.yhat_lower_95 == r.yhat == r.yhat_upper_95 for r in fc)   # zero residuals


def test_exact_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("2.01"), 2), (Decimal("-2.01"), 2), (Decimal("1"), 3)],
                               "t decimal(10,2), n long")
    got = [r[0] for r in df.select(marts.exact_mean_cents(F.col("t"), F.col("n"))).collect()]
    assert got == [1.01, -1.0, 0.33]


def test_distinct_counts_without_expand(spark):
    rows = [("a", 1, "x", 10), ("a", 1, "x", 5), ("a", 2, None, 1), ("b", None, None, 2), (None, 3, "y", 4)]
    df = spark.createDataFrame(rows, "k string, o int, p string, v int")
    out = marts.with_distinct_counts(df, ("k",), [F.sum("v").alias("total")], {"orders": "o", "products": "p"})
    got = {r.k: (r.total, r.orders, r.products) for r in out.collect()}
    assert got == {"a": (16, 2, 1), "b": (2, 0, 0), None: (4, 1, 1)}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_mean_cents_is_exact_and_null_without_items(spark):
    df = spark.createDataFrame([("1.00", 3), ("90000000000000.01", 1), ("0.05", 2), ("1.00", 0)], "t string, n long")
    got = df.select(marts.exact_mean_cents(F.col("t").cast("decimal(20,2)"), F.col("n")).alias("m")).collect()
    assert [r.m for r in got] == [0.33, 90000000000000.01, 0.03, None]


def test_churn_split_counts_both_sides(spark):
    from starmart.operators.churn import split_profile

    rows = [(dt.datetime(2020, m, 1), int(m % 2)) for m in range(1, 11)]
    got = split_profile(spark.createDataFrame(rows, "month timestamp_ntz, is_churned int")).collect()[0]
    assert (got.split_month, got.train_rows, got.train_churned, got.test_rows, got.test_churned) == (
        dt.datetime(2020, 8, 1), 8, 4, 2, 1)
