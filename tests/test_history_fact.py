import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.operators.fact import (
    SchemaDrift, assert_same_schema, keep_latest, lookback_filter, upsert_by_key,
)
from starmart.operators.scd2 import current_rows, snapshot_check
from starmart.operators.temporal_join import heavy_keys, join_as_of, version_ranges

SRC = "k string, a int, b string, extra string"
T1, T2, T3 = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1)


def _run(spark, batches):
    open_rows, closed = None, []
    for rows, ts in batches:
        hb = snapshot_check(open_rows, spark.createDataFrame(rows, SRC), "k", ["a", "b"], ts)
        closed.append(hb.newly_closed)
        open_rows = hb.open.cache()
    hist = open_rows
    for c in closed:
        hist = hist.unionByName(c)
    return hist


def test_snapshot_check_three_batches(spark):
    b1 = [("same", 1, "x", "e"), ("chg", 1, "x", "e"), ("gone", 1, "x", "e"),
          ("nul", None, "x", "e"), ("untracked", 1, "x", "e1")]
    b2 = [("same", 1, "x", "e"), ("chg", 2, "x", "e"), ("nul", 5, "x", "e"),
          ("untracked", 1, "x", "e2"), ("new", 1, "y", "e")]
    b3 = [("same", 1, "x", "e"), ("chg", 2, "x", "e"), ("nul", None, "x", "e"),
          ("untracked", 1, "x", "e3"), ("new", 1, "y", "e")]
    hist = _run(spark, [(b1, T1), (b2, T2), (b3, T3)])
    rows = {}
    for r in hist.collect():
        rows.setdefault(r.k, []).append(r)
    for k in rows:
        rows[k].sort(key=lambda r: r.dbt_valid_from)
    assert [(r.dbt_valid_from, r.dbt_valid_to) for r in rows["same"]] == [(T1, None)]
    assert [(r.a, r.dbt_valid_from, r.dbt_valid_to) for r in rows["chg"]] == \
        [(1, T1, T2), (2, T2, None)]
    assert [(r.a, r.dbt_valid_to) for r in rows["nul"]] == [(None, T2), (5, T3), (None, None)]
    assert [(r.dbt_valid_from, r.dbt_valid_to) for r in rows["gone"]] == [(T1, None)]
    assert [(r.extra, r.dbt_valid_to) for r in rows["untracked"]] == [("e1", None)]
    assert [(r.dbt_valid_from, r.dbt_valid_to) for r in rows["new"]] == [(T2, None)]
    # laws: exactly one open version per key, ranges contiguous
    for k, versions in rows.items():
        assert sum(v.dbt_valid_to is None for v in versions) == 1
        for a, b in zip(versions, versions[1:]):
            assert a.dbt_valid_to == b.dbt_valid_from
    cur = current_rows(hist, ["k", "a"]).collect()
    assert len(cur) == 6 and all(r.snapshot_updated_at is not None for r in cur)
    # repeating the last batch changes nothing
    again = _run(spark, [(b1, T1), (b2, T2), (b3, T3), (b3, dt.datetime(2020, 4, 1))])
    assert again.count() == hist.count()


def _history(spark):
    rows = [("c1", "K1", T1, T2), ("c1", "K1", T2, None), ("c2", "K2", T2, None)]
    return spark.createDataFrame(
        rows, "customer_id string, customer_key string, dbt_valid_from timestamp_ntz, "
              "dbt_valid_to timestamp_ntz")


def test_join_as_of_edges_and_hot_split(spark):
    facts = spark.createDataFrame([
        ("o1", "c1", dt.datetime(1999, 1, 1)),    # before the first version: floored -> match
        ("o2", "c1", T2),                          # exactly at valid_to of v1 -> v2
        ("o3", "c1", T2 - dt.timedelta(seconds=1)),
        ("o4", "c2", dt.datetime(2030, 1, 1)),    # open version
        ("o5", "zz", T2),                          # unknown key
    ], "id string, customer_id string, ts timestamp_ntz")
    hist = _history(spark).withColumn("customer_key",
                                      F.concat("customer_key", F.lit("@"),
                                               F.date_format("dbt_valid_from", "MM")))
    ranges = version_ranges(hist, "customer_id", ["customer_key"])
    plain = {r.id: r.customer_key
             for r in join_as_of(facts, ranges, "customer_id", "ts", ["customer_key"]).collect()}
    assert plain == {"o1": "K1@01", "o2": "K1@02", "o3": "K1@01", "o4": "K2@02", "o5": None}
    hot = heavy_keys(facts, "customer_id", parts=2)
    assert [r.customer_id for r in hot.collect()] == ["c1"]
    split = {r.id: r.customer_key for r in
             join_as_of(facts, ranges, "customer_id", "ts", ["customer_key"], hot).collect()}
    assert split == plain


def test_lookback_boundary_and_upsert(spark):
    mx = dt.datetime(2020, 1, 10)
    lines = spark.createDataFrame([(d,) for d in (7, 8, 6)],
                                  "day int").select(
        F.make_timestamp_ntz(F.lit(2020), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0))
        .alias("invoice_date"))
    kept = sorted(r.invoice_date.day for r in lookback_filter(lines, mx, 3).collect())
    assert kept == [7, 8]                      # exactly 3 days late is accepted, 4 is not
    target = spark.createDataFrame([("a", 1), ("b", 1)], "order_item_id string, v int")
    batch = spark.createDataFrame([("b", 2), ("c", 2)], "order_item_id string, v int")
    once = upsert_by_key(target, batch, "order_item_id")
    twice = upsert_by_key(once, batch, "order_item_id")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_keep_latest_and_schema_guard(spark):
    df = spark.createDataFrame([("k", T1, 1), ("k", T2, 1), ("k", T2, 2)],
                               "order_item_id string, invoice_date timestamp_ntz, seq int")
    got = keep_latest(df, "order_item_id", seq_col="seq").collect()
    assert len(got) == 1 and got[0].seq == 2 and got[0].invoice_date == T2
    assert_same_schema(df, df.select(*reversed(df.columns)))
    with pytest.raises(SchemaDrift):
        assert_same_schema(df, df.withColumn("extra", F.lit(1)))
    with pytest.raises(SchemaDrift):
        assert_same_schema(df, df.withColumn("seq", F.col("seq").cast("string")))


def test_read_declared_refuses_drift(spark, tmp_path):
    from starmart.sources.tables import read_declared

    df = spark.createDataFrame([("a", 1)], "k string, v int")
    path = str(tmp_path / "src")
    df.write.parquet(path)
    assert read_declared(spark, path, df.schema).count() == 1
    with pytest.raises(SchemaDrift):
        read_declared(spark, path, df.withColumn("extra", F.lit(1)).schema)


def test_join_as_of_salts_a_hot_key_without_losing_or_repeating_rows(spark):
    day = dt.timedelta(days=1)
    facts = spark.createDataFrame(
        [(f"o{i}", "c1", T1 + i * day) for i in range(60)]
        + [(f"p{i}", "c2", T2 + i * day) for i in range(3)]
        + [("n1", None, T1), ("n2", "c1", None)],
        "id string, customer_id string, ts timestamp_ntz")
    hist = _history(spark).withColumn("customer_key", F.date_format("dbt_valid_from", "MM"))
    ranges = version_ranges(hist, "customer_id", ["customer_key"])
    hot = heavy_keys(facts, "customer_id", parts=8)
    assert {(r.customer_id, r.salts) for r in hot.collect()} == {("c1", 8)}   # ceil(61 * 8 / 65)
    plain = join_as_of(facts, ranges, "customer_id", "ts", ["customer_key"])
    salted = join_as_of(facts, ranges, "customer_id", "ts", ["customer_key"], hot)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    assert salted.count() == 65 and salted.filter("customer_key IS NULL").count() == 2
    none = join_as_of(facts.limit(0), ranges, "customer_id", "ts", ["customer_key"],
                      heavy_keys(facts.limit(0), "customer_id"))
    assert none.count() == 0


def test_run_batch_full_refresh_rebuilds_same_fact(spark):
    from starmart.plans import build as b
    from starmart.sources import raw_order_lines

    raw = raw_order_lines(spark, "/root/testdata/sf0.001")
    state = b.BuildState()
    b.run_batch(spark, b.cut_before(raw, dt.date(1999, 1, 1), "invoice_date"),
                dt.datetime(1999, 1, 1, 6), state)
    b.run_batch(spark, raw, dt.datetime(2001, 8, 2), state)
    incremental = b.fact(spark, state)
    first_path = state.fact_path
    b.run_batch(spark, raw, dt.datetime(2001, 8, 3), state, full_refresh=True)
    assert state.fact_path != first_path
    rebuilt = b.fact(spark, state)
    assert rebuilt.count() == incremental.count() == 5942
    assert rebuilt.exceptAll(incremental).count() == 0
    # history: the second and third runs closed versions, one open version per key
    hist = state.customers.all()
    assert hist.filter("dbt_valid_to IS NULL").groupBy("customer_id").count() \
        .filter("count > 1").count() == 0
    assert hist.filter("dbt_valid_to IS NOT NULL").count() > 0


def test_next_day_runs_from_the_stored_tables(spark, tmp_path):
    from starmart.plans import build as b
    from starmart.sources import raw_order_lines

    raw = raw_order_lines(spark, "/root/testdata/sf0.001")
    root = str(tmp_path / "warehouse")
    days = ((dt.date(2000, 1, 10), dt.datetime(2000, 1, 10, 6)),
            (dt.date(2000, 1, 12), dt.datetime(2000, 1, 12, 6)))
    kept = b.BuildState()
    for cut, ts in days:
        b.run_batch(spark, b.cut_before(raw, cut, "invoice_date"), ts, kept)
    assert b.load_state(spark, root).batch == 0
    cut, ts = days[0]
    b.run_batch(spark, b.cut_before(raw, cut, "invoice_date"), ts, b.load_state(spark, root))
    before = b.load_state(spark, root)
    # what a run that died left behind: rows of a batch that no state row makes current
    b.fact(spark, before).withColumn("date_month", F.lit(200001)).write \
        .partitionBy("date_month").parquet(f"{root}/fact/batch=2")
    assert b.fact(spark, b.load_state(spark, root)).count() == b.fact(spark, before).count()
    cut, ts = days[1]
    b.run_batch(spark, b.cut_before(raw, cut, "invoice_date"), ts, b.load_state(spark, root))
    after = b.load_state(spark, root)
    assert after.batch == 2 and after.months == kept.months
    # the second batch holds only the months it touched
    second = spark.read.parquet(f"{root}/fact/batch=2").select("date_month").distinct().collect()
    assert {r[0] for r in second} == {m for m, n in after.months.items() if n == 2} == {200001}
    for one, two in ((b.fact(spark, after), b.fact(spark, kept)),
                     (after.customers.all(), kept.customers.all()),
                     (after.products.all(), kept.products.all())):
        two = two.select(*one.columns)
        assert one.count() == two.count() > 0 and one.exceptAll(two).count() == 0
    # the state as it was before the second batch still reads the first one's fact
    assert b.fact(spark, before).filter("invoice_date >= TIMESTAMP_NTZ'2000-01-10'").count() == 0


def test_join_as_of_compares_no_fact_with_every_version(spark):
    """1,000 versions of the hot key, gaps included: the plan holds no join on the key, and each
    fact meets one version (a residual-range join would meet 1,000)."""
    hour = dt.timedelta(hours=1)
    history = [("c1", f"v{i}", T1 + i * hour, T1 + (i + (0.5 if i % 10 == 3 else 1)) * hour) for i in range(1000)] \
        + [("c2", "w", T1, None)]
    hist = spark.createDataFrame(history, "customer_id string, customer_key string, dbt_valid_from timestamp_ntz, "
                                          "dbt_valid_to timestamp_ntz")
    facts = [(i, "c1", T1 + dt.timedelta(minutes=20 * i - 60)) for i in range(3100)] + [(5000, "c2", T2)]
    rows = spark.createDataFrame(facts, "id int, customer_id string, ts timestamp_ntz")
    ranges = version_ranges(hist, "customer_id", ["customer_key"])
    hot = heavy_keys(rows, "customer_id", parts=4)
    for heavy in (None, hot):
        out = join_as_of(rows, ranges, "customer_id", "ts", ["customer_key"], heavy)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert all("__hot" in line for line in joins) and "Window" in plan
        got = {r.id: r.customer_key for r in out.collect()}
        want = {}
        for i, k, ts in facts:
            want[i] = next((v for c, v, lo, hi in history if c == k and (lo <= ts or v in ("v0", "w")) and (hi is None or ts < hi)), None)
        assert got == want and sum(v is None for v in want.values()) > 100


def test_join_as_of_deals_no_column_that_nobody_reads(spark):
    facts = spark.createDataFrame([("o1", "c1", T2, "x" * 50)], "id string, customer_id string, ts timestamp_ntz, wide string")
    ranges = version_ranges(_history(spark), "customer_id", ["customer_key"])
    out = join_as_of(facts, ranges, "customer_id", "ts", ["customer_key"])
    assert out.columns == ["id", "customer_id", "ts", "wide", "customer_key"] and out.first().wide == "x" * 50
    plan = out.select("id", "customer_key")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("wide" in line and "xxhash64" not in line for line in plan.splitlines() if "Union" in line or "Project" in line or "Window" in line)


def test_salted_fact_deals_no_column_that_nobody_reads(spark):
    from starmart.operators import calendar as cal
    from starmart.operators.fact import sales_fact
    from starmart.operators.staging import clean_order_lines

    raw = spark.createDataFrame([(str(i), "p", "a thing", "2", "2020-01-10 10:00:00", "1.50", "c1", "X") for i in range(9)],
                                "invoice_no string, stock_code string, description string, quantity string, invoice_date string, "
                                "unit_price string, customer_id string, country string")
    lines = clean_order_lines(raw)
    products = spark.createDataFrame([("p", "P", T1, None)], "stock_code string, product_key string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    hot = [heavy_keys(lines, k, parts=4) for k in ("customer_id", "stock_code")]
    fact = sales_fact(lines, _history(spark), products, cal.calendar(cal.calendar_bounds(lines)), *hot)
    assert fact.count() == 9 and {(r.customer_key, r.product_key) for r in fact.collect()} == {("K1", "P")}
    plan = fact.select("product_key", "quantity")._jdf.queryExecution().optimizedPlan().toString()
    assert "order_item_id" not in plan and "md5" not in plan
