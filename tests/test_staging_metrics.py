import datetime as dt

from starmart.config import PipelineConfig, Thresholds
from starmart.operators import metrics
from starmart.operators.staging import clean_order_lines

RAW = "invoice_no string, stock_code string, description string, quantity string, " \
      "invoice_date string, unit_price string, customer_id string, country string"


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_raw_filter_runs_before_trim_and_cast(spark):
    rows = [
        ("  ", "S1", "d", "1", "2010-01-01 10:00:00", "1.00", "1", "UK"),   # passes, becomes ''
        ("", "S1", "d", "1", "2010-01-01 10:00:00", "1.00", "1", "UK"),     # blank: dropped
        ("I1", "S1", "d", "1", "not a date", "1.00", "1", "UK"),           # passes, NULL date
        ("I2", "S1", "d", "1", "2010-01-01 10:00:00", "0", "1", "UK"),      # price 0: dropped
        ("I3", "S1", "d", "1", "2010-01-01 10:00:00", "-1", "1", "UK"),     # negative: dropped
        ("I4", "S1", "d", "1", "2010-01-01 10:00:00", "abc", "1", "UK"),    # bad price: dropped
        ("I5", "S1", "d", "x", "2010-01-01 10:00:00", "1.00", " ", "UK"),   # bad qty kept
        ("I6", None, "d", "1", "2010-01-01 10:00:00", "1.00", "1", "UK"),   # null code: dropped
    ]
    out = {r.invoice_no: r for r in clean_order_lines(raw_df(spark, rows)).collect()}
    assert set(out) == {"", "I1", "I5"}
    assert out["I1"].invoice_date is None
    assert out["I5"].quantity is None and out["I5"].is_return is None
    assert out["I5"].customer_id == "__missing"


def test_dedup_tie_breaks(spark):
    base = ("I1", "S1", None, "1", "2010-01-01 10:00:00", "1.00", "C1", "UK")

    def row(desc, country="UK", qty="1", price="1.00"):
        r = list(base)
        r[2], r[7], r[3], r[5] = desc, country, qty, price
        return tuple(r)

    cases = [
        ([row("short"), row("longer one")], ("longer one", "UK")),
        ([row("bbb"), row("aaa")], ("aaa", "UK")),
        ([row(None), row("x")], ("x", "UK")),
        ([row("same", "FR"), row("same", "DE")], ("same", "DE")),
    ]
    for rows, expected in cases:
        got = clean_order_lines(raw_df(spark, rows)).collect()
        assert len(got) == 1 and (got[0].description, got[0].country) == expected
    # equal description and country: smallest quantity, then price
    got = clean_order_lines(raw_df(spark, [row("d", qty="5"), row("d", qty="3", price="9.00"),
                                           row("d", qty="3", price="2.00")])).collect()
    assert (got[0].quantity, str(got[0].unit_price)) == (3, "2.00")


def _lines(spark, rows):
    raw = raw_df(spark, rows)
    return clean_order_lines(raw)


def test_segments_at_thresholds(spark):
    rows = []
    # C10: 10 orders, gross 1000 exactly -> high; C9: 9 orders -> medium; C2: 2 orders -> low
    for i in range(10):
        rows.append((f"A{i}", "S1", "d", "1", "2010-01-01 10:00:00", "100.00", "C10", "UK"))
    for i in range(9):
        rows.append((f"B{i}", "S1", "d", "1", "2010-01-01 10:00:00", "500.00", "C9", "UK"))
    for i in range(2):
        rows.append((f"D{i}", "S1", "d", "1", "2010-01-02 10:00:00", "1.00", "C2", "UK"))
    rows.append(("E0", "S1", "d", "1", "2010-01-01 10:00:00", "1.00", "", "UK"))
    # C11: 10 orders but gross 999.99 (a return does not count) -> medium
    for i in range(10):
        rows.append((f"F{i}", "S1", "d", "1", "2010-01-01 10:00:00",
                     "99.99" if i == 0 else "100.00", "C11", "UK"))
    cm = {r.customer_id: r for r in metrics.customer_metrics(_lines(spark, rows)).collect()}
    assert cm["C10"].customer_segment == "high_value"
    assert cm["C11"].customer_segment == "medium_value"
    assert cm["C9"].customer_segment == "medium_value"
    assert cm["C2"].customer_segment == "low_value"
    assert cm["__missing"].customer_segment == "unknown"
    assert cm["C2"].recency_days == 0 and cm["C10"].recency_days == 1
    cfg = PipelineConfig(thresholds=Thresholds(2, 0.0, 1))
    cm2 = {r.customer_id: r for r in metrics.customer_metrics(_lines(spark, rows), cfg).collect()}
    assert cm2["C2"].customer_segment == "high_value"


def test_order_metrics_returns_and_flags(spark):
    rows = [
        ("I1", "S1", "d", "2", "2010-01-01 10:00:00", "1.50", "C1", "UK"),
        ("I1", "S2", "d", "-1", "2010-01-01 10:00:00", "2.00", "C1", "UK"),
        ("I2", "S1", "d", "x", "2010-01-01 11:00:00", "1.00", "C1", "UK"),
    ]
    om = {r.invoice_no: r for r in metrics.order_metrics(_lines(spark, rows)).collect()}
    i1 = om["I1"]
    assert (i1.line_item_count, i1.unique_items, i1.total_quantity) == (2, 2, 1)
    assert (i1.forward_item_count, i1.total_order_value, i1.forward_order_value) == (1, 1.0, 3.0)
    assert i1.has_returns is True
    i2 = om["I2"]  # NULL quantity: forward count 1, values NULL / 0, return flag NULL
    assert i2.forward_item_count == 1 and i2.has_returns is None
    assert i2.forward_order_value == 0.0


def test_product_mode_and_mean_price(spark):
    rows = [
        ("I1", "S1", "beta", "1", "2010-01-01 10:00:00", "1.00", "C1", "UK"),
        ("I2", "S1", "alpha", "1", "2010-01-01 10:00:00", "1.01", "C1", "UK"),
        ("I3", "S2", None, "1", "2010-01-01 10:00:00", "1.00", "C1", "UK"),
        ("I4", "S2", None, "1", "2010-01-01 10:00:00", "1.00", "C1", "UK"),
        ("I5", "S2", "x", "1", "2010-01-01 10:00:00", "1.00", "C2", "UK"),
    ]
    pm = {r.stock_code: r for r in metrics.product_metrics(_lines(spark, rows)).collect()}
    assert pm["S1"].description == "alpha"      # tie -> alphabetical
    assert pm["S1"].avg_price == 1.01           # 1.005 exactly -> half up
    assert pm["S2"].description == "Unknown"    # NULL is the mode
    assert pm["S2"].unique_customers == 2 and pm["S2"].order_count == 3


def test_calendar_bounds_end_exclusive_and_empty_raises(spark):
    import pytest

    from starmart.operators.calendar import calendar, calendar_bounds, calendar_between

    lines = spark.createDataFrame([(dt.datetime(2020, 2, 29, 12),)], "invoice_date timestamp_ntz")
    cal = calendar(calendar_bounds(lines)).collect()
    days = sorted(r.full_date for r in cal)
    assert days[0] == dt.date(2020, 2, 22) and days[-1] == dt.date(2020, 3, 6)
    assert len(days) == 14
    leap = [r for r in cal if r.full_date == dt.date(2020, 2, 29)][0]
    assert (leap.date_key, leap.day_of_year, leap.is_weekend) == (20200229, 60, True)
    wk = {r.full_date: r.week_of_year
          for r in calendar_between(spark, dt.date(2009, 12, 28), dt.date(2010, 1, 5)).collect()}
    assert wk[dt.date(2010, 1, 3)] == 53 and wk[dt.date(2010, 1, 4)] == 1
    empty = spark.createDataFrame([], "invoice_date timestamp_ntz")
    with pytest.raises(Exception, match="empty"):
        calendar(calendar_bounds(empty)).collect()


def test_raw_lines_are_not_dealt_by_customer(spark):
    from starmart.sources import raw_order_lines

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = raw_order_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(i for i, x in enumerate(plan) if "Join [o_custkey" in x)
    depth = plan[at].index("SortMergeJoin")
    below = [x for x in plan[at + 1:] if len(x) - len(x.lstrip(" :+-")) > depth]
    assert any("c_custkey" in x for x in below) and not any("l_partkey" in x for x in below)
