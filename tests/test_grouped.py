"""Metrics whose lines are dealt once: same results with and without heavy keys, cuts in one pass."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.operators import metrics
from starmart.operators.staging import clean_order_lines, stored_lines, with_line_keys

from .test_staging_metrics import RAW

ROWS = [("1", "p", "thing", "2", "2001-01-03 10:00:00", "1.50", "a", "UK"),
        ("1", "q", "other", "-1", "2001-01-03 10:00:00", "2.50", "a", "UK"),
        ("1", "p", "thing", "3", "2001-02-04 10:00:00", "1.00", "a", "UK"),       # an invoice and product of an earlier cut
        ("2", "p", "a thing", "4", "2001-02-03 10:00:00", "9.00", "b", "FR"),
        ("3", "p", "a thing", "x", "2001-03-03 10:00:00", "0.50", "", "FR"),
        ("4", "p", None, "1", "2001-03-04 10:00:00", "0.75", "", None),
        ("5", "r", None, "1", "no date", "7.00", "c", "UK")]
CUTS = (dt.datetime(2001, 2, 1), dt.datetime(2001, 3, 1), None)


def _lines(spark):
    return clean_order_lines(spark.createDataFrame(ROWS, RAW)).cache()


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def _ways(spark, key):
    """No knowledge of heavy keys, none heavy, one heavy."""
    keys = spark.createDataFrame([({"customer_id": "a", "stock_code": "p"}[key],)], f"{key} string").cache()
    return None, keys.limit(0), keys


def test_cuts_in_one_pass_equal_the_metrics_of_each_cut(spark):
    lines = _lines(spark)
    first = F.coalesce(*[F.when(F.col("invoice_date") < F.lit(c).cast("timestamp_ntz") if c else F.lit(True), i) for i, c in enumerate(CUTS)])
    tagged = lines.withColumn(metrics.CUT, first)
    for of, key in ((metrics.customer_metrics, "customer_id"), (metrics.product_metrics, "stock_code")):
        for hot in _ways(spark, key):
            got = of(tagged, None, hot, len(CUTS)).cache()
            for i, c in enumerate(CUTS):
                there = lines if c is None else lines.where(F.col("invoice_date") < F.lit(c).cast("timestamp_ntz"))
                assert _rows(got.where(F.col(metrics.CUT) == i).drop(metrics.CUT)) == _rows(of(there)), (key, i)


def test_heavy_keys_change_no_metric(spark):
    lines = _lines(spark)
    for of, key in ((metrics.customer_metrics, "customer_id"), (metrics.product_metrics, "stock_code")):
        ways = [_rows(of(lines, None, hot)) for hot in _ways(spark, key)]
        assert ways[0] and ways[0] == ways[1] == ways[2]
    p = {r.stock_code: r for r in metrics.product_metrics(lines).collect()}["p"]
    assert (p.order_count, p.unique_customers, p.description, p.total_quantity_sold) == (4, 3, "a thing", 10)
    assert (p.min_price, p.max_price, p.avg_price) == (0.5, 9.0, 2.55)


def test_product_metrics_deal_a_line_once(spark):
    plan = metrics.product_metrics(_lines(spark), None, _ways(spark, "stock_code")[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning") == 1


def test_stored_lines_leave_out_what_follows_from_them(spark):
    raw = spark.createDataFrame(ROWS, RAW)
    stored = stored_lines(raw)
    assert not {"order_item_id", "is_return", "invoice_date_only"} & set(stored.columns)
    assert _rows(with_line_keys(stored)) == _rows(clean_order_lines(raw))


def test_distinct_counts_deal_a_row_once(spark):
    from starmart.operators import marts

    key = "0123456789abcdef" * 2
    df = spark.createDataFrame([(key, "2001-01", "o1", "UK", 2, 1), ("c1", "2001-01", "o1", "UK", 3, 1), ("c1", "2001-01", "o2", None, 4, 5),
                                ("-1", "2001-02", "o2", "FR", None, 2), (None, None, None, None, 1, 3), (key, "2001-01", "o2", "UK", 5, 9)],
                               "customer_key string, month string, o string, country string, v int, at int").cache()
    sums = {"total": ("sum", F.col("v")), "first": ("min", F.col("at")), "last": ("max", F.col("at"))}
    counts = {"orders": "o", "countries": "country"}
    by = ("customer_key", "month")
    hot = spark.createDataFrame([(key, "2001-01"), ("c1", "2001-01")], "customer_key string, month string").cache()
    dealt = marts.with_distinct_counts(df, by, sums, counts, hot.limit(0).cache())
    assert _rows(marts.with_distinct_counts(df, by, sums, counts)) == _rows(dealt) == _rows(marts.with_distinct_counts(df, by, sums, counts, hot))
    assert {r.customer_key: (r.orders, r.countries, r.total) for r in dealt.collect()} == {
        key: (2, 1, 7), "c1": (2, 1, 7), "-1": (1, 1, None), None: (0, 0, 1)}
    assert dealt._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0].count("Exchange hashpartitioning") == 1


def test_packed_keys_come_back(spark):
    from starmart.functions.keys import packed_key, unpacked_key

    keys = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "-1", "", "x" * 16, "\0" * 17 + "é", None]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", unpacked_key(packed_key("k")).alias("again"), packed_key("k").alias("p")).collect()
    assert all(r.again == r.k for r in got) and len({r.p for r in got}) == len(keys) and len(got[0].p) == 16
