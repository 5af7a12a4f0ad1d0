"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed over the whole driver tables (or data Spark derives from them)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import PipelineConfig, Thresholds
from starmart.functions import safe_decimal, safe_int, safe_timestamp, ts_lit
from starmart.operators import calendar as cal
from starmart.operators import metrics
from starmart.operators.staging import clean_order_lines, stored_lines, typed_order_lines, with_line_keys
from starmart.session import written
from starmart.sources import freshness, raw_load_profile, raw_order_lines, table
from starmart.sources.driver_tables import arrival_delay, dirty_order_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed parameters of the registered queries.
AS_OF = dt.datetime(2001, 8, 2, 12, 0, 0)         # "now" for time-relative queries
CUSTOM_THRESHOLDS = Thresholds(high_value_min_orders=10,
                               high_value_min_revenue=1_500_000.0,
                               medium_value_min_orders=8)
NO_REVENUE_NEEDED = Thresholds(high_value_min_orders=3, high_value_min_revenue=-1e12,
                               medium_value_min_orders=2)
LOAD_DELAY_HOURS = 30                              # raw rows land this long after the order


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def staging(spark: SparkSession, sf_dir: str, cfg: PipelineConfig | None = None) -> DataFrame:
    return clean_order_lines(raw_order_lines(spark, sf_dir), cfg)


def written_staging(spark: SparkSession, raw: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Staging for queries that read it more than once."""
    from starmart.plans import build as b

    return with_line_keys(b.Warehouse(spark).materialize(stored_lines(raw), "staging"), cfg)


def _heavy(spark, stg: DataFrame) -> list[DataFrame]:
    """Heavy customers and products, salted or summed where they are read."""
    from starmart.plans import build as b

    return [b.Warehouse(spark).heavy(stg, k) for k in ("customer_id", "stock_code")]


# --------------------------------------------------------------- sources
@query("raw_order_lines")
def q_raw_order_lines(spark, sf_dir):
    return raw_order_lines(spark, sf_dir)


@query("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    """Raw order lines written as CSV, with quotes, commas and newlines in the
    description, and read back by the CSV source."""
    from starmart.session import scratch_path
    from starmart.sources import read_order_csv
    from starmart.sources.csv_orders import write_order_csv

    raw = raw_order_lines(spark, sf_dir).withColumn("description", F.concat(
        "description", F.lit(', "'), "stock_code", F.lit('"\n'), "country"))
    path = scratch_path(spark, "raw-csv")
    write_order_csv(raw, path)
    return read_order_csv(spark, path, AS_OF).drop("_ingested_at")


INGEST_CUT = dt.date(1999, 1, 1)                    # first load: orders before; the rest comes with the second
INGEST_TIMES = (dt.datetime(2001, 7, 30, 6), dt.datetime(2001, 8, 1, 18))


def _ingested(spark, sf_dir):
    """Warehouse folder after two CSV loads, with quotes and newlines in the descriptions."""
    from starmart.plans.ingest import ingest_csv
    from starmart.session import scratch_path
    from starmart.sources.csv_orders import write_order_csv

    raw = _once(spark, raw_order_lines(spark, sf_dir)).withColumn("description", F.concat(
        "description", F.lit(', "'), "stock_code", F.lit('"\n'), "country"))
    day, root = F.col("invoice_date").try_cast("timestamp_ntz"), scratch_path(spark, "warehouse")
    for part, ts in zip((raw.filter(day < ts_lit(INGEST_CUT)), raw.filter(day >= ts_lit(INGEST_CUT))), INGEST_TIMES):
        path = scratch_path(spark, "raw-csv")
        write_order_csv(part, path)
        ingest_csv(spark, path, ts, root)
    return root


@query("ingest_published")
def q_ingest_published(spark, sf_dir):
    """CSV files to published tables: rows of every relation after two loads."""
    from starmart.plans.ingest import published

    return published(spark, _ingested(spark, sf_dir))


@query("ingest_freshness")
def q_ingest_freshness(spark, sf_dir):
    """Freshness of each country by the stamps that the two loads wrote."""
    from starmart.plans.ingest import load_freshness

    return load_freshness(spark, _ingested(spark, sf_dir), AS_OF)


@query("csv_split_round_trip")
def q_csv_split_round_trip(spark, sf_dir):
    """``csv_round_trip`` through the reader that splits files with quoted newlines."""
    from starmart.session import scratch_path
    from starmart.sources.csv_orders import read_order_csv_split, write_order_csv

    raw = raw_order_lines(spark, sf_dir).withColumn("description", F.concat(
        "description", F.lit(', "'), "stock_code", F.lit('"\n'), "country"))
    path = scratch_path(spark, "raw-csv")
    write_order_csv(raw, path)
    return read_order_csv_split(spark, path, AS_OF).drop("_ingested_at")


@query("load_validation")
def q_load_validation(spark, sf_dir):
    return raw_load_profile(raw_order_lines(spark, sf_dir), PipelineConfig().min_load_rows)


@query("source_freshness")
def q_source_freshness(spark, sf_dir):
    raw = raw_order_lines(spark, sf_dir).withColumn(
        "_ingested_at",
        F.col("invoice_date").cast("timestamp_ntz") + F.expr(f"interval {LOAD_DELAY_HOURS} hours"))
    return freshness(raw, "_ingested_at", AS_OF, group_by=("country",))


# --------------------------------------------------------------- staging
@query("clean_order_lines")
def q_clean_order_lines(spark, sf_dir):
    s = staging(spark, sf_dir)
    return s.withColumn("unit_price", F.col("unit_price").cast("double"))


@query("safe_cast_matrix")
def q_safe_cast_matrix(spark, sf_dir):
    """The safe casts over text shapes derived from every lineitem row."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    k = F.col("l_linenumber")
    frac = (F.col("l_orderkey") % 10).cast("string")
    int_text = (
        F.when(k == 1, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("."), frac))
        .when(k == 2, F.concat(F.lit("-"), (F.col("l_quantity").cast("int")).cast("string"),
                               F.lit(".5")))
        .when(k == 3, F.concat((F.col("l_partkey") % 9).cast("string"), F.lit("e"),
                               (F.col("l_orderkey") % 4).cast("string")))
        .when(k == 4, F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" ")))
        .when(k == 5, F.concat(F.col("l_partkey").cast("string"), F.lit("0000000000")))
        .when(k == 6, F.concat(F.lit("2.4999999"), frac))
        .otherwise(F.col("l_returnflag")))
    day = F.to_date("o_orderdate").cast("string")
    ts_text = (
        F.when(k == 1, F.col("o_orderdate").cast("string"))
        .when(k == 2, day)
        .when(k == 3, F.substring(day, 1, 4))
        .when(k == 4, F.substring(day, 1, 7))
        .when(k == 5, F.concat(day, F.lit(" 08:"), frac, F.lit("5")))
        .when(k == 6, F.concat(F.lit("x"), day))
        .otherwise(F.concat(F.col("l_returnflag"), F.lit("/1/1995"))))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    units = ((cents - cents % 100) / 100).cast("bigint")
    dec_text = (
        F.when(k == 1, F.concat(units.cast("string"), F.lit("."),
                                F.lpad((cents % 100).cast("string"), 2, "0"), frac))
        .when(k == 2, F.concat(F.lit("-"), units.cast("string")))
        .when(k == 3, F.concat((cents * 1000).cast("string"), F.lit(".5")))
        .when(k == 4, F.concat(F.lit("0.00"), frac))
        .otherwise(F.col("l_linestatus")))
    return j.select(
        F.col("l_orderkey").alias("l_orderkey"), F.col("l_linenumber").alias("l_linenumber"),
        F.col("l_partkey").alias("l_partkey"),
        int_text.alias("int_text"), safe_int(int_text).alias("as_int"),
        ts_text.alias("ts_text"), safe_timestamp(ts_text).alias("as_ts"),
        dec_text.alias("dec_text"),
        safe_decimal(dec_text).cast("double").alias("as_decimal"),
    )


# --------------------------------------------------------------- metrics
@query("order_metrics")
def q_order_metrics(spark, sf_dir):
    return metrics.order_metrics(staging(spark, sf_dir))


@query("customer_metrics")
def q_customer_metrics(spark, sf_dir):
    stg = written_staging(spark, raw_order_lines(spark, sf_dir))
    return metrics.customer_metrics(stg, hot=_heavy(spark, stg)[0])


@query("customer_segments_custom")
def q_customer_segments_custom(spark, sf_dir):
    cfg = PipelineConfig(thresholds=CUSTOM_THRESHOLDS)
    return metrics.customer_metrics(staging(spark, sf_dir, cfg), cfg) \
        .select("customer_id", "total_orders", "gross_revenue", "customer_segment")


@query("product_metrics")
def q_product_metrics(spark, sf_dir):
    return metrics.product_metrics(staging(spark, sf_dir))


@query("product_best_name")
def q_product_best_name(spark, sf_dir):
    return metrics.best_description(staging(spark, sf_dir))


@query("calendar")
def q_calendar(spark, sf_dir):
    # the date is part of the staging grain: its bounds are the same before the dedup
    return cal.calendar(cal.calendar_bounds(typed_order_lines(raw_order_lines(spark, sf_dir))))


# --------------------------------------------------------------- history and fact
# Fixed parameters: three daily loads cut at these dates, run at these times.
LOAD_CUTS = (
    (dt.date(1997, 1, 1), dt.datetime(1997, 1, 1, 6, 0, 0)),
    (dt.date(1999, 1, 1), dt.datetime(1999, 1, 1, 6, 0, 0)),
    (None, AS_OF),
)


def _history(spark, sf_dir, which: str, stg: DataFrame | None = None, loads=LOAD_CUTS, hot: DataFrame | None = None):
    """History after ``loads`` (the three of LOAD_CUTS, in order of time).  The metrics
    as of every cut are computed in one pass (each staged line is tagged with the first
    cut it belongs to), written once, and the snapshot batches then run in order."""
    from starmart.plans import build as b

    wh = b.Warehouse(spark)
    if stg is None:
        stg = written_staging(spark, raw_order_lines(spark, sf_dir))
    cfg = PipelineConfig()
    first = F.coalesce(*[F.when(F.lit(True) if cut is None else F.col("invoice_date") < ts_lit(cut), F.lit(i))
                         for i, (cut, _) in enumerate(loads)])
    by = (metrics.CUT,)
    tagged = stg.withColumn(metrics.CUT, first).where(F.col(metrics.CUT).isNotNull())
    if which == "customer":
        hot = wh.heavy(stg, "customer_id") if hot is None else hot
        src = metrics.customer_metrics(tagged, cfg, hot, len(loads)).select(*by, *b.CUSTOMER_SNAPSHOT_COLUMNS)
        check, key = cfg.customer_check_cols, "customer_id"
    else:
        hot = wh.heavy(stg, "stock_code") if hot is None else hot
        src = metrics.product_metrics(tagged, cfg, hot, len(loads)).select(*by, *b.PRODUCT_SNAPSHOT_COLUMNS)
        check, key = cfg.product_check_cols, "stock_code"
    per_cut = wh.materialize(src, f"{which}-metrics-by-cut", partition_by=by)
    hist = b.History(key)
    for i, (_, ts) in enumerate(loads):
        batch = per_cut.filter(F.col(metrics.CUT) == i).drop(metrics.CUT)
        hist = b.snapshot_step(wh, hist, batch, check, ts, f"{which}-history")
    return hist


@query("customer_history")
def q_customer_history(spark, sf_dir):
    return _history(spark, sf_dir, "customer").all()


@query("product_history")
def q_product_history(spark, sf_dir):
    return _history(spark, sf_dir, "product").all()


@query("current_customers")
def q_current_customers(spark, sf_dir):
    from starmart.plans import build as b
    from starmart.operators.scd2 import current_rows

    return current_rows(_history(spark, sf_dir, "customer").all(), b.CUSTOMER_SNAPSHOT_COLUMNS)


@query("current_products")
def q_current_products(spark, sf_dir):
    from starmart.plans import build as b
    from starmart.operators.scd2 import current_rows

    return current_rows(_history(spark, sf_dir, "product").all(), b.PRODUCT_SNAPSHOT_COLUMNS)


def _incremental_build(spark, raw, loads):
    """Run the daily build over cumulative raw loads, each from the stored
    tables alone, as a new process would; returns the stored state."""
    from starmart.plans import build as b
    from starmart.session import scratch_path

    root = scratch_path(spark, "warehouse")
    for cut, ts in loads:
        b.run_batch(spark, b.cut_before(raw, cut, "invoice_date"), ts, b.load_state(spark, root))
    return b.load_state(spark, root)


@query("sales_fact")
def q_sales_fact(spark, sf_dir):
    """Full build: one run over everything, histories from three loads."""
    from starmart.operators.fact import fact_output, packed_fact, unpacked_fact

    stg = written_staging(spark, raw_order_lines(spark, sf_dir))
    # heavy natural keys (>= 1/64 of the lines) are salted
    hot = _heavy(spark, stg)
    histories = [_history(spark, sf_dir, w, stg, hot=h).all() for w, h in zip(("customer", "product"), hot)]
    return fact_output(unpacked_fact(packed_fact(stg, *histories, cal.calendar(cal.calendar_bounds(stg)), *hot)))


# Two loads so early that some customers and products are not in them.
EARLY_CUTS = (
    (dt.date(1995, 4, 1), dt.datetime(1995, 4, 1, 6, 0, 0)),
    (dt.date(1996, 1, 1), dt.datetime(1996, 1, 1, 6, 0, 0)),
)


@query("fact_versions")
def q_fact_versions(spark, sf_dir):
    """The customer and product version each staged line joins to, over
    histories of two early loads only: keys first seen later have none."""
    from starmart.operators.scd2 import SCD_ID
    from starmart.operators.temporal_join import join_as_of, version_ranges

    stg = written_staging(spark, raw_order_lines(spark, sf_dir))
    out = stg.select("order_item_id", "customer_id", "stock_code", "invoice_date")
    for which, key, hot in zip(("customer", "product"), ("customer_id", "stock_code"), _heavy(spark, stg)):
        versions = _history(spark, sf_dir, which, stg, EARLY_CUTS, hot).all()
        ranges = version_ranges(versions.withColumnRenamed(SCD_ID, f"{which}_version"), key,
                                [f"{which}_version"])
        out = join_as_of(out, ranges, key, "invoice_date", [f"{which}_version"], hot)
    return out.select("order_item_id",
                      *[F.coalesce(f"{w}_version", F.lit("-1")).alias(f"{w}_version")
                        for w in ("customer", "product")])


def _once(spark, raw):
    """Raw lines that several batches take their parts from: joined once and written."""
    from starmart.plans import build as b

    return b.Warehouse(spark).materialize(raw, "raw-lines")


def _delta_batches(spark, raw, loads):
    """Warehouse folder after applying the lines of each load, each batch from
    the stored snapshot alone, as a new process would."""
    from starmart.plans import incremental as inc
    from starmart.session import scratch_path

    raw, root = _once(spark, raw), scratch_path(spark, "warehouse")
    day = F.col("invoice_date").try_cast("timestamp_ntz")
    for lo, hi, ts in loads:
        part = raw if lo is None else raw.filter(day >= ts_lit(lo))
        inc.apply_batch(spark, part if hi is None else part.filter(day < ts_lit(hi)), ts, root)
    return root


@query("fact_unknown_keys")
def q_fact_unknown_keys(spark, sf_dir):
    """The fact over histories of two early loads only: customers and products
    first seen later have the unknown key."""
    from starmart.operators.fact import fact_output, packed_fact, unpacked_fact

    stg = written_staging(spark, raw_order_lines(spark, sf_dir))
    hot = _heavy(spark, stg)
    histories = [_history(spark, sf_dir, w, stg, EARLY_CUTS, h).all() for w, h in zip(("customer", "product"), hot)]
    return fact_output(unpacked_fact(packed_fact(stg, *histories, cal.calendar(cal.calendar_bounds(stg)), *hot)))


@query("sales_fact_incremental")
def q_sales_fact_incremental(spark, sf_dir):
    """Three loads, each of the lines since the last one, and the last one sent
    again (idempotence); must equal the full-refresh fact."""
    from starmart.operators.fact import fact_output
    from starmart.plans import incremental as inc

    cuts = [None, *[cut for cut, _ in LOAD_CUTS]]
    loads = [(lo, hi, ts) for lo, (hi, ts) in zip(cuts, LOAD_CUTS)]
    root = _delta_batches(spark, raw_order_lines(spark, sf_dir), loads + loads[-1:])
    return fact_output(inc.fact(spark, root))


def _delta_metrics(which):
    def run(spark, sf_dir):
        """Faulty lines in three batches in no order of time, the two descriptions of a
        line in different batches, and one batch sent twice; the metrics kept by deltas
        must equal those of all lines at once."""
        from starmart.plans import incremental as inc
        from starmart.session import scratch_path

        raw, root = _once(spark, dirty_order_lines(spark, sf_dir)), scratch_path(spark, "warehouse")
        spare = F.coalesce(F.col("description").endswith("(spare) ").cast("int"), F.lit(0))
        part = F.pmod(F.hash("invoice_no", "stock_code") + spare, F.lit(3))
        for i, hours in ((0, 1), (2, 2), (1, 3), (2, 4)):
            inc.apply_batch(spark, raw.filter(part == i), AS_OF + dt.timedelta(hours=hours), root)
        return inc.metrics_now(spark, root, which)
    return run


for _which in ("order", "customer", "product"):
    REGISTRY[f"incremental_{_which}_metrics"] = _delta_metrics(_which)


@query("compacted_snapshot")
def q_compacted_snapshot(spark, sf_dir):
    """Staged lines after two batches that replace each other's rows, a compaction and a vacuum."""
    from starmart.plans import incremental as inc
    from starmart.session import scratch_path
    from starmart.sources.snapshots import SnapshotStore

    raw, root = _once(spark, dirty_order_lines(spark, sf_dir)), scratch_path(spark, "warehouse")
    spare = F.coalesce(F.col("description").endswith("(spare) "), F.lit(False))
    inc.apply_batch(spark, raw.filter(~spare), AS_OF, root)
    inc.apply_batch(spark, raw.filter(spare), AS_OF + dt.timedelta(days=1), root)
    inc.compact(spark, root)
    SnapshotStore(spark, root).vacuum(1)
    return inc.lines(spark, root).withColumn("unit_price", F.col("unit_price").cast("double"))


LATE_CUT = dt.date(2000, 1, 1)       # first load: orders before this day
LATE_SPAN_DAYS = 3                   # second load: the next days, plus everything resent


@query("sales_fact_late_rows")
def q_sales_fact_late_rows(spark, sf_dir):
    """Rows a second run (re)writes: those at or after max(target) - 3 days."""
    from starmart.operators.fact import fact_output, target_max_ts
    from starmart.plans import build as b

    second = LATE_CUT + dt.timedelta(days=LATE_SPAN_DAYS)
    raw = _once(spark, raw_order_lines(spark, sf_dir))
    state = _incremental_build(spark, raw, ((LATE_CUT, dt.datetime(2000, 1, 1, 6)),))
    first = b.fact(spark, state)
    first_ids = b.Warehouse(spark).materialize(
        first.select("order_item_id", F.lit(True).alias("was_loaded")), "first-load")
    first_max = target_max_ts(first)
    b.run_batch(spark, b.cut_before(raw, second, "invoice_date"),
                dt.datetime(2000, 1, 4, 6), state)
    floor = first_max - dt.timedelta(days=PipelineConfig().lookback_days)
    touched = b.fact(spark, state).filter(F.col("invoice_date") >= ts_lit(floor))
    marked = touched.join(first_ids, "order_item_id", "left").withColumn(
        "was_loaded", F.coalesce("was_loaded", F.lit(False)))
    return fact_output(marked, ("was_loaded",))


@query("late_arrivals")
def q_late_arrivals(spark, sf_dir):
    """Lines arrive 0 to 30 days after their order.  Of what arrives with the
    second load, the fact takes the lines at most three days older than its
    newest line, and later ones stay out."""
    from starmart.operators.fact import fact_output
    from starmart.plans import incremental as inc
    from starmart.session import scratch_path

    raw, root = _once(spark, raw_order_lines(spark, sf_dir)), scratch_path(spark, "warehouse")
    arrived = F.date_add(F.to_date(F.col("invoice_date").try_cast("timestamp_ntz")), arrival_delay())
    inc.apply_batch(spark, raw.filter(arrived < F.lit(LATE_CUT)), dt.datetime(2000, 1, 1, 6), root)
    inc.apply_batch(spark, raw.filter(arrived >= F.lit(LATE_CUT)), AS_OF, root)
    return fact_output(inc.fact(spark, root))


@query("fact_layout")
def q_fact_layout(spark, sf_dir):
    """Month-partitioned, clustered fact re-compacted into a new location."""
    from starmart.operators.fact import fact_output
    from starmart.plans import build as b
    from starmart.session import scratch_path
    from starmart.sources.tables import compact_fact, read_fact

    state = _incremental_build(spark, raw_order_lines(spark, sf_dir), (LOAD_CUTS[-1],))
    new_path = scratch_path(spark, "fact-compacted")
    compact_fact(spark, state.fact_path, new_path)
    return fact_output(read_fact(spark, new_path))


LAYOUT_COLUMNS = ("invoice_date_only", "stock_code", "customer_id")
LAYOUT_FILES = 64


@query("clustering_depth")
def q_clustering_depth(spark, sf_dir):
    """Depth and files read per column, of staged lines sorted by day and of the
    same lines in Z-order of day, product and customer."""
    from starmart.operators.layout import layout_report, write_z_ordered
    from starmart.session import scratch_path

    stg = staging(spark, sf_dir).select(*LAYOUT_COLUMNS, "quantity", "unit_price")
    by_day, by_z = scratch_path(spark, "lines-by-day"), scratch_path(spark, "lines-by-z")
    stg.repartitionByRange(LAYOUT_FILES, "invoice_date_only", F.xxhash64(*stg.columns)).sortWithinPartitions("invoice_date_only").write.parquet(by_day)
    write_z_ordered(spark.read.parquet(by_day), LAYOUT_COLUMNS, by_z, LAYOUT_FILES)
    reports = [layout_report(spark.read.parquet(p), LAYOUT_COLUMNS).select(F.lit(n).alias("layout"), "*")
               for n, p in (("by_day", by_day), ("z_order", by_z))]
    return reports[0].unionAll(reports[1])


# --------------------------------------------------------------- data-quality checks
def star_tables(spark, sf_dir, write_fact: bool = False, raw: DataFrame | None = None,
                fact_columns: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """All ten relations of one build run at AS_OF over ``raw`` (by default the
    driver tables' order lines); staging and metrics are written once, the rest is
    lazy; the fact too is written (with ``fact_columns`` only, if given) for queries
    that read it more than once."""
    from starmart.operators.fact import packed_fact, unpacked_fact
    from starmart.operators.scd2 import current_rows, snapshot_check
    from starmart.plans import build as b

    cfg = PipelineConfig()
    wh = b.Warehouse(spark)
    stg = written_staging(spark, raw_order_lines(spark, sf_dir) if raw is None else raw)
    hot_c, hot_p = _heavy(spark, stg)
    # read by several relations (metrics, history, dims, fact): written once
    cm = wh.materialize(metrics.customer_metrics(stg, cfg, hot_c), "customer-metrics")
    pm = wh.materialize(metrics.product_metrics(stg, cfg, hot_p), "product-metrics")
    calendar = cal.calendar(cal.calendar_bounds(stg))
    ch = snapshot_check(None, cm.select(*b.CUSTOMER_SNAPSHOT_COLUMNS), "customer_id",
                        cfg.customer_check_cols, AS_OF).open
    ph = snapshot_check(None, pm.select(*b.PRODUCT_SNAPSHOT_COLUMNS), "stock_code",
                        cfg.product_check_cols, AS_OF).open
    fact = packed_fact(stg, ch, ph, calendar, hot_c, hot_p)
    if fact_columns is not None:
        fact = unpacked_fact(fact).select(*fact_columns)
        fact = wh.materialize(fact, "fact") if write_fact else fact
    else:  # written as it was dealt: a line's own key is a hash that no encoding shortens
        fact = unpacked_fact(wh.materialize(fact, "fact") if write_fact else fact)
    return {
        "staging": stg,
        "order_metrics": metrics.order_metrics(stg, cfg),
        "customer_metrics": cm,
        "product_metrics": pm,
        "calendar": calendar,
        "customer_history": ch,
        "product_history": ph,
        "dim_customers": current_rows(ch, b.CUSTOMER_SNAPSHOT_COLUMNS),
        "dim_products": current_rows(ph, b.PRODUCT_SNAPSHOT_COLUMNS),
        "fact": fact,
    }


def _checks_query(select, source=raw_order_lines, damage=None):
    def run(spark, sf_dir):
        from starmart.operators.checks import run_checks
        from starmart.plans import build as b
        from starmart.plans.check_ledger import ledger

        checks = [c for c in ledger() if select(c)]
        several = any(c.kind in ("relationships", "unique") for c in checks)
        tables = star_tables(spark, sf_dir, several, source(spark, sf_dir))
        if any(c.table == "order_metrics" for c in checks):
            wh, stg = b.Warehouse(spark), tables["staging"]
            hot = wh.heavy(stg, "invoice_no", "customer_id")
            tables["order_metrics"] = wh.materialize(metrics.order_metrics(stg, hot=hot), "order-metrics")
        for name, (again, columns) in (damage or {}).items():
            t = tables[name].withColumns({c: F.expr(e) for c, e in columns.items()})
            tables[name] = t.unionByName(t.filter(again))
        return run_checks(tables, checks, AS_OF)
    return run


# Damage done to built tables so that every kind of check has failures: rows that are
# there twice, and columns replaced by an expression (plain SQL, used by the oracle too).
_OTHER_SEGMENT = {"customer_segment": "CASE WHEN total_orders = 7 THEN 'vip' ELSE customer_segment END"}
_NO_PRICE = {"min_price": "CASE WHEN order_count = 5 THEN 0 ELSE min_price END"}
DAMAGE = {
    "staging": ("quantity = 7", {"unit_price": "CASE WHEN quantity = 5 THEN -unit_price ELSE unit_price END"}),
    "order_metrics": ("line_item_count = 3", {
        "unique_items": "CASE WHEN line_item_count = 2 THEN 0 ELSE unique_items END"}),
    "customer_metrics": ("total_orders = 5", _OTHER_SEGMENT),
    "product_metrics": ("order_count = 9", _NO_PRICE),
    "dim_customers": ("total_orders = 4", _OTHER_SEGMENT),
    "dim_products": ("order_count = 8", {"avg_price": "CASE WHEN order_count = 5 THEN NULL ELSE avg_price END"}),
    "calendar": ("day = 31", {"day_name": "CASE WHEN month = 2 THEN NULL ELSE day_name END"}),
    "fact": ("quantity = 6", {"customer_key": "CASE WHEN quantity = 4 THEN 'gone' ELSE customer_key END",
                              "unit_price": "CASE WHEN quantity = 5 THEN 0 ELSE unit_price END"}),
    "customer_history": ("total_orders = 6", _OTHER_SEGMENT),
    "product_history": ("order_count = 7", _NO_PRICE),
}


CHECK_GROUPS = {
    "check_not_null": lambda c: c.kind == "not_null",
    "check_unique": lambda c: c.kind == "unique" and not c.where,
    "check_unique_current": lambda c: c.kind == "unique" and bool(c.where),
    "check_accepted_values": lambda c: c.kind == "accepted_values",
    "check_relationships": lambda c: c.kind == "relationships",
    "check_positive": lambda c: c.kind == "positive_value",
    "check_not_in_future": lambda c: c.kind == "not_in_future",
    "check_expression": lambda c: c.kind == "expression_is_true",
}
for _name, _sel in CHECK_GROUPS.items():
    REGISTRY[_name] = _checks_query(_sel)
# the whole ledger over the order lines as they are, and over faulty lines and damaged tables
REGISTRY["check_all"] = _checks_query(lambda c: True)
REGISTRY["check_failures"] = _checks_query(lambda c: True, dirty_order_lines, DAMAGE)


@query("dirty_staging")
def q_dirty_staging(spark, sf_dir):
    """Staging of order lines with faults."""
    return clean_order_lines(dirty_order_lines(spark, sf_dir)) \
        .withColumn("unit_price", F.col("unit_price").cast("double"))


@query("dirty_segment_revenue")
def q_dirty_segment_revenue(spark, sf_dir):
    """High-value customers without positive gross revenue: those who only sent
    goods back, under thresholds that let them in."""
    from starmart.operators.checks import high_value_negative

    cfg = PipelineConfig(thresholds=NO_REVENUE_NEEDED)
    lines = clean_order_lines(dirty_order_lines(spark, sf_dir), cfg)
    return high_value_negative(metrics.customer_metrics(lines, cfg))


@query("stored_failures")
def q_stored_failures(spark, sf_dir):
    """Failing lines kept by check runs after each of two batches, the second of
    which replaces lines of the first; only lines that still stand."""
    from starmart.plans import check_runs
    from starmart.plans import incremental as inc
    from starmart.session import scratch_path

    raw, root = _once(spark, dirty_order_lines(spark, sf_dir)), scratch_path(spark, "warehouse")
    spare = F.coalesce(F.col("description").endswith("(spare) "), F.lit(False))
    for i, part in enumerate((raw.filter(~spare), raw.filter(spare))):
        inc.apply_batch(spark, part, AS_OF + dt.timedelta(days=i), root)
        check_runs.check_new_lines(spark, root, AS_OF, AS_OF + dt.timedelta(days=i))
    return check_runs.current_failures(spark, root)


@query("check_row_parity")
def q_check_row_parity(spark, sf_dir):
    from starmart.operators.checks import row_parity

    t = star_tables(spark, sf_dir)
    return row_parity(spark, t["fact"], t["staging"], PipelineConfig().row_parity_tolerance)


@query("check_segment_revenue")
def q_check_segment_revenue(spark, sf_dir):
    """High-value customers must have positive gross revenue; run with the
    custom thresholds so the high-value segment is populated."""
    from starmart.operators.checks import high_value_negative

    cfg = PipelineConfig(thresholds=NO_REVENUE_NEEDED)
    return high_value_negative(metrics.customer_metrics(staging(spark, sf_dir, cfg), cfg))


@query("check_grain")
def q_check_grain(spark, sf_dir):
    """Grain of staging: (invoice_no, stock_code, invoice_date, customer_id)
    must be unique; raw lines are *not* unique on (order, line number)."""
    from starmart.operators.checks import grain_duplicates

    raw = raw_order_lines(spark, sf_dir)
    return grain_duplicates(raw, ["invoice_no", "stock_code", "invoice_date", "customer_id"])


@query("history_depth")
def q_history_depth(spark, sf_dir):
    from starmart.operators.checks import history_depth

    return history_depth(_history(spark, sf_dir, "customer").all(), "customer_id")


# --------------------------------------------------------------- marts
def _marts_inputs(spark, sf_dir, write_fact=True, fact_columns=None):
    t = star_tables(spark, sf_dir, write_fact, fact_columns=fact_columns)
    return t, t["fact"], t["calendar"]


def _churn_inputs(spark, sf_dir):
    """The fact as the churn features read it, several times: without its key and day."""
    return _marts_inputs(spark, sf_dir, fact_columns=(
        "customer_key", "product_key", "invoice_date", "invoice_no", "is_return", "quantity", "revenue", "country"))


def _churn_features(spark, fact):
    from starmart.operators import marts
    from starmart.plans import build as b

    return marts.churn_features(fact, b.Warehouse(spark).heavy(marts.customer_months(fact), "customer_key", "month"))


def _daily_metrics(spark, fact, calendar):
    from starmart.operators import marts
    from starmart.plans import build as b

    return marts.daily_metrics(fact, calendar, b.Warehouse(spark).heavy(fact, "date_key"))


@query("daily_metrics")
def q_daily_metrics(spark, sf_dir):
    _, fact, calendar = _marts_inputs(spark, sf_dir)
    return _daily_metrics(spark, fact, calendar)


@query("daily_metrics_by_country")
def q_daily_metrics_by_country(spark, sf_dir):
    from starmart.operators import marts

    _, fact, calendar = _marts_inputs(spark, sf_dir, False)
    return marts.daily_metrics_by_country(fact, calendar)


@query("churn_features")
def q_churn_features(spark, sf_dir):
    _, fact, _ = _churn_inputs(spark, sf_dir)
    return _churn_features(spark, fact)


@query("churn_candidates")
def q_churn_candidates(spark, sf_dir):
    from starmart.operators import marts

    t, fact, _ = _churn_inputs(spark, sf_dir)
    return marts.churn_candidates(_churn_features(spark, fact), t["dim_customers"], AS_OF)


@query("product_demand_series")
def q_product_demand_series(spark, sf_dir):
    from starmart.operators import marts

    t, fact, _ = _marts_inputs(spark, sf_dir, False)
    return marts.product_demand_series(fact, t["product_history"])


def _daily(spark, sf_dir):
    _, fact, calendar = _marts_inputs(spark, sf_dir)
    return _daily_metrics(spark, fact, calendar)


# forecasts are fitted on the days before this date and compared with the days after
FORECAST_AS_OF = dt.datetime(2001, 7, 2)


@query("seasonal_forecast")
def q_seasonal_forecast(spark, sf_dir):
    from starmart.operators import marts

    return marts.seasonal_forecast(marts.daily_series(_daily(spark, sf_dir), FORECAST_AS_OF))


@query("product_forecast")
def q_product_forecast(spark, sf_dir):
    """Three months of demand per product, by the same month of earlier years."""
    from starmart.operators import marts

    t, fact, _ = _marts_inputs(spark, sf_dir, False)
    # the forecast reads the series several times
    demand = written(marts.product_demand_series(fact, t["product_history"]), "demand")
    return marts.seasonal_forecast(demand, horizon=3, period=12, step="month")


def _before_forecast(spark, sf_dir):
    from starmart.operators import marts

    return marts.daily_series(_daily(spark, sf_dir), FORECAST_AS_OF)


@query("smoothing_backtest")
def q_smoothing_backtest(spark, sf_dir):
    """Rolling-origin error of every smoothing model and of the seasonal-naive one, per series."""
    from starmart.operators.smoothing import smoothing_models

    models = smoothing_models(_before_forecast(spark, sf_dir))
    return models.select("unique_id", "model_name", F.round("mae", 4).alias("mae"))


@query("smoothed_forecast")
def q_smoothed_forecast(spark, sf_dir):
    """Thirty days of each daily series by its best model of the back-test."""
    from starmart.operators.smoothing import smoothed_forecast

    return smoothed_forecast(_before_forecast(spark, sf_dir))


@query("forecast_vs_actual")
def q_forecast_vs_actual(spark, sf_dir):
    from starmart.operators import marts

    daily = _daily(spark, sf_dir)
    fc = marts.seasonal_forecast(marts.daily_series(daily, FORECAST_AS_OF))
    return marts.forecast_vs_actual(daily, fc, FORECAST_AS_OF)


@query("customer_360")
def q_customer_360(spark, sf_dir):
    from starmart.operators import marts
    from starmart.plans import build as b

    t, fact, _ = _marts_inputs(spark, sf_dir)
    return marts.customer_360(fact, t["dim_customers"], b.Warehouse(spark).heavy(fact, "customer_key"))


@query("product_performance")
def q_product_performance(spark, sf_dir):
    from starmart.operators import marts

    t, fact, _ = _marts_inputs(spark, sf_dir, False)
    return marts.product_performance(fact, t["dim_products"])


@query("revenue_overview")
def q_revenue_overview(spark, sf_dir):
    from starmart.operators import marts

    _, fact, calendar = _marts_inputs(spark, sf_dir, False)
    return marts.revenue_overview(fact, calendar)


@query("order_value_by_month")
def q_order_value_by_month(spark, sf_dir):
    from starmart.operators import marts

    t, _, _ = _marts_inputs(spark, sf_dir)
    return marts.order_value_by_month(t["order_metrics"])


@query("check_daily_sigma")
def q_check_daily_sigma(spark, sf_dir):
    from starmart.operators.checks import daily_row_sigma

    t, fact, _ = _marts_inputs(spark, sf_dir, False)
    return daily_row_sigma(fact, "invoice_date", AS_OF)


@query("check_moving_stdev")
def q_check_moving_stdev(spark, sf_dir):
    from starmart.operators import marts
    from starmart.operators.checks import moving_stdev_check

    _, fact, calendar = _marts_inputs(spark, sf_dir)
    by_country = marts.daily_metrics_by_country(fact, calendar)
    return moving_stdev_check(by_country, "date_day", "gross_revenue", AS_OF,
                              group_by=("country",))


def _moving_stdev_query(column, **options):
    def run(spark, sf_dir):
        from starmart.operators.checks import moving_stdev_check

        return moving_stdev_check(_daily(spark, sf_dir), "date_day", column, AS_OF, **options)
    return run


REGISTRY["check_moving_stdev_log"] = _moving_stdev_query("order_count", take_logs=True)
REGISTRY["check_moving_stdev_revenue"] = _moving_stdev_query("net_revenue")
REGISTRY["check_moving_stdev_returns"] = _moving_stdev_query("return_item_count")


# --------------------------------------------------------------- model and stream
@query("churn_split")
def q_churn_split(spark, sf_dir):
    """Rows and churned rows of the training and the test months."""
    from starmart.operators import marts
    from starmart.operators.churn import split_profile

    _, fact, _ = _churn_inputs(spark, sf_dir)
    return split_profile(_churn_features(spark, fact).filter("is_churned IN (0, 1)"))


@query("churn_feature_auc")
def q_churn_feature_auc(spark, sf_dir):
    """How well each feature alone tells churned customer months apart (rank-sum AUC with ties)."""
    from starmart.operators.evaluation import rank_auc

    return rank_auc(_labelled_features(spark, sf_dir), "value", "is_churned", ("feature",))


def _labelled_features(spark, sf_dir):
    from starmart.operators import marts

    _, fact, _ = _churn_inputs(spark, sf_dir)
    rows = _churn_features(spark, fact).filter("is_churned IN (0, 1)").fillna(0, subset=list(marts.CHURN_FEATURES))
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in marts.CHURN_FEATURES]))
    return rows.select("is_churned", values.alias("v")).select("is_churned", "v.*")


CHURN_RULE = 2.0                                    # "two or more" of a feature says churned


@query("churn_rule_confusion")
def q_churn_rule_confusion(spark, sf_dir):
    """Confusion table, precision, recall and F1 of the rule that two or more of a feature mean churn."""
    from starmart.operators.evaluation import confusion

    return confusion(_labelled_features(spark, sf_dir), "value", "is_churned", CHURN_RULE, ("feature",))


@query("churn_training_report")
def q_churn_training_report(spark, sf_dir):
    """Held-out metrics of the churned class, row counts and feature importances."""
    from starmart.operators import marts
    from starmart.operators.churn import train_churn
    from starmart.plans import build as b

    _, fact, _ = _churn_inputs(spark, sf_dir)
    features = b.Warehouse(spark).materialize(_churn_features(spark, fact), "churn-features")
    return train_churn(spark, features)[1]


@query("churn_scores")
def q_churn_scores(spark, sf_dir):
    """Train on the labelled monthly features (time-ordered split) and score
    each customer's latest month before the as-of month."""
    from starmart.operators import marts
    from starmart.operators.churn import score_churn, train_churn
    from starmart.operators.dedup import keep_first
    from starmart.plans import build as b

    _, fact, _ = _churn_inputs(spark, sf_dir)
    features = b.Warehouse(spark).materialize(_churn_features(spark, fact), "churn-features")
    model, _ = train_churn(spark, features)
    month_now = F.date_trunc("month", ts_lit(AS_OF)).cast("timestamp_ntz")
    latest = keep_first(features.filter(F.col("month") < month_now), ["customer_key"],
                        [F.col("month").desc()])
    return score_churn(model, latest)


@query("stream_fact_upsert")
def q_stream_fact_upsert(spark, sf_dir):
    """Three raw loads arrive as files, each with lines that were sent before;
    each availableNow run of the stream starts from the stored snapshot and its
    checkpoint.  Must equal the full-refresh fact."""
    from starmart.operators.fact import fact_output
    from starmart.plans import incremental as inc
    from starmart.session import PARQUET, scratch_path
    from starmart.streaming.fact_stream import stream_upsert

    raw = _once(spark, raw_order_lines(spark, sf_dir))
    day = F.col("invoice_date").try_cast("timestamp_ntz")
    in_dir, ckpt, root = (scratch_path(spark, n) for n in ("inbox", "stream-ckpt", "warehouse"))
    lower = None
    for cut, ts in LOAD_CUTS:
        load = raw if cut is None else raw.filter(day < ts_lit(cut))
        if lower is not None:  # the two days before the cut are sent again
            load = load.filter(day >= ts_lit(lower - dt.timedelta(days=2)))
        load.write.mode("append").options(**PARQUET).parquet(in_dir)
        lower = cut
        stream_upsert(spark, in_dir, ckpt, root, lambda epoch, ts=ts: ts).awaitTermination()
    return fact_output(inc.fact(spark, root))
