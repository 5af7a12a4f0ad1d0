"""End-to-end build order, one batch at a time.

raw -> staging -> {order, customer, product metrics, calendar}
    -> {customer, product history} -> {current dims, fact (incremental)}

Every layer with more than one consumer is *written* to the shared work
folder (``spark.checkpoint.dir``) and read back: that cuts the lineage (a lost
executor recomputes from the last written layer, not from the raw files) and
stops Spark from recomputing staging once per consumer.

The lasting tables are kept in a warehouse folder, one sub-folder per batch:
``customers`` and ``products`` (history, ``batch=n/__part=open|closed``), ``fact``
(``batch=n/date_month=m``) and ``state`` (``batch=n``, one row: the batch whose
files hold each month of the fact).  A batch only adds folders; writing its one
state row, last, makes all of it current at once.  A run that dies before leaves
the tables as they were, and the next run writes over its folders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit
from starmart.config import PipelineConfig
from starmart.operators import calendar as cal
from starmart.operators import metrics
from starmart.operators.fact import (
    assert_same_schema, keep_latest, lookback_filter, packed_fact, target_max_ts, unpacked_fact, upsert_by_key,
)
from starmart.operators.scd2 import PART, HistoryBatch, current_rows, snapshot_check
from starmart.operators.staging import stored_lines, with_line_keys
from starmart.operators.temporal_join import heavy_keys
from starmart.session import PARQUET, scratch_path
from starmart.sources.tables import MONTH, batch_months, write_fact

# The columns of the histories.
CUSTOMER_SNAPSHOT_COLUMNS = (
    "customer_key", "customer_id", "total_orders", "total_revenue", "gross_revenue",
    "return_count", "total_items", "total_quantity", "first_order_date", "last_order_date",
    "recency_days", "customer_segment",
)
PRODUCT_SNAPSHOT_COLUMNS = (
    "product_key", "stock_code", "description", "order_count", "total_quantity_sold",
    "total_revenue", "gross_revenue", "return_count", "unique_customers", "min_price",
    "max_price", "avg_price",
)


STAGING_MONTH = "invoice_month"


def _month_of(ts_col: str):
    return (F.year(ts_col) * 100 + F.month(ts_col)).cast("int")


@dataclass
class Warehouse:
    spark: SparkSession

    def materialize(self, df: DataFrame, name: str,
                    partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` to a fresh folder under the shared work folder and read
        it back (cuts the lineage; consumers share one computation)."""
        path = scratch_path(self.spark, name)
        w = df.write.partitionBy(*partition_by) if partition_by else df.write
        w.options(**PARQUET).parquet(path)
        # without rows, a partitioned folder has no file to tell its columns
        return (self.spark.read.schema(df.schema) if partition_by else self.spark.read).parquet(path)

    def heavy(self, lines: DataFrame, *key: str) -> DataFrame:
        """The heavy keys of written lines, written."""
        parts = max(64, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        if len(key) > 1:
            both = heavy_keys(lines.select(F.struct(*key).alias("__keys")), "__keys", parts=parts)
            return self.materialize(both.select("__keys.*"), "hot-keys")
        return self.materialize(heavy_keys(lines, *key, parts=parts), f"hot-{key[0]}")


@dataclass
class History:
    """Type-2 history kept as an append-only closed part and an open part."""

    key: str
    closed: DataFrame | None = None
    open: DataFrame | None = None

    def all(self) -> DataFrame:
        if self.open is None:
            raise ValueError("history is empty")
        return self.open if self.closed is None else self.closed.unionByName(self.open)


def snapshot_step(wh: Warehouse, hist: History, source: DataFrame,
                  check_cols: tuple[str, ...], batch_ts: dt.datetime, name: str,
                  path: str | None = None) -> History:
    """Run one snapshot batch and write its output once (to ``path``, or to the
    work folder), partitioned into the new open part and the newly closed rows
    (appended to the closed part)."""
    hb: HistoryBatch = snapshot_check(hist.open, source, hist.key, check_cols, batch_ts)
    path = path or scratch_path(wh.spark, name)
    hb.combined.write.mode("overwrite").options(**PARQUET).partitionBy(PART).parquet(path)
    written = wh.spark.read.parquet(path)
    new_open = written.filter(F.col(PART) == "open").drop(PART)
    newly_closed = written.filter(F.col(PART) == "closed").drop(PART)
    if hist.open is None:
        return History(hist.key, None, new_open)
    closed = newly_closed if hist.closed is None else hist.closed.unionByName(newly_closed)
    return History(hist.key, closed, new_open)


@dataclass
class BuildState:
    customers: History = field(default_factory=lambda: History("customer_id"))
    products: History = field(default_factory=lambda: History("stock_code"))
    root: str | None = None                 # warehouse folder (None: one in the work folder)
    batch: int = 0                          # last finished batch
    months: dict[int, int] = field(default_factory=dict)   # fact month -> batch that holds it

    @property
    def fact_path(self) -> str | None:
        """Folder of the last fact batch that wrote anything."""
        return f"{self.root}/fact/batch={max(self.months.values())}" if self.months else None

    @property
    def fact_exists(self) -> bool:
        return bool(self.months)


STATE_SCHEMA = "batch_ts timestamp_ntz, months map<int,int>"


def save_state(spark: SparkSession, state: BuildState, batch_ts: dt.datetime) -> None:
    """Make the batch current: one row in one file, so it is there or it is not."""
    spark.createDataFrame([(batch_ts, state.months)], STATE_SCHEMA).coalesce(1) \
        .write.mode("overwrite").parquet(f"{state.root}/state/batch={state.batch}")


def load_state(spark: SparkSession, root: str) -> BuildState:
    """The state after the last finished batch of the warehouse folder ``root``;
    an empty state if no batch has been finished there."""
    state = BuildState(root=root.rstrip("/"))
    try:
        stored = spark.read.schema(STATE_SCHEMA + ", batch int").parquet(f"{state.root}/state")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return state
    last = stored.orderBy(F.col("batch").desc()).limit(1).collect()
    if not last:
        return state
    state.batch, state.months = int(last[0]["batch"]), dict(last[0]["months"])
    for hist, name in ((state.customers, "customers"), (state.products, "products")):
        stored = spark.read.parquet(f"{state.root}/{name}")
        part, batch = F.col(PART), F.col("batch")
        hist.open = stored.filter((part == "open") & (batch == state.batch)).drop(PART, "batch")
        hist.closed = stored.filter((part == "closed") & (batch <= state.batch)).drop(PART, "batch")
    return state


@dataclass
class BatchOutputs:
    staging: DataFrame
    order_metrics: DataFrame
    customer_metrics: DataFrame
    product_metrics: DataFrame
    calendar: DataFrame
    fact_batch: DataFrame


def run_batch(spark: SparkSession, raw: DataFrame, batch_ts: dt.datetime,
              state: BuildState, cfg: PipelineConfig | None = None,
              full_refresh: bool = False) -> BatchOutputs:
    """One daily run over the raw relation loaded so far; its results are stored
    in ``state.root``, and ``state`` is what ``load_state`` finds there next."""
    cfg = cfg or PipelineConfig()
    wh = Warehouse(spark)
    state.root = state.root or scratch_path(spark, "warehouse")
    number = state.batch + 1
    # staging partitioned by invoice month: the look-back read prunes to recent months
    stg = with_line_keys(wh.materialize(
        stored_lines(raw).withColumn(STAGING_MONTH, _month_of("invoice_date")),
        "staging", partition_by=(STAGING_MONTH,)), cfg, STAGING_MONTH)
    # a key is heavy when it would fill more than one shuffle partition on its own
    hot_c, hot_p = wh.heavy(stg, "customer_id"), wh.heavy(stg, "stock_code")
    om = metrics.order_metrics(stg, cfg)
    cm = wh.materialize(metrics.customer_metrics(stg, cfg, hot_c), "customer-metrics")
    pm = wh.materialize(metrics.product_metrics(stg, cfg, hot_p), "product-metrics")
    calendar = wh.materialize(cal.calendar(cal.calendar_bounds(stg, cfg.calendar_pad_days)),
                              "calendar")

    state.customers = snapshot_step(wh, state.customers,
                                    cm.select(*CUSTOMER_SNAPSHOT_COLUMNS),
                                    cfg.customer_check_cols, batch_ts, "customer-history",
                                    f"{state.root}/customers/batch={number}")
    state.products = snapshot_step(wh, state.products, pm.select(*PRODUCT_SNAPSHOT_COLUMNS),
                                   cfg.product_check_cols, batch_ts, "product-history",
                                   f"{state.root}/products/batch={number}")

    target = fact(spark, state) if state.months and not full_refresh else None
    # the newest fact row lies in the newest month: only that one is read
    todo = stg if target is None else lookback_filter(
        stg, target_max_ts(fact(spark, state, [max(state.months)])), cfg.lookback_days)
    packed = packed_fact(todo, state.customers.all(), state.products.all(), calendar, hot_c, hot_p)
    batch = unpacked_fact(packed, cfg.surrogate_null_token)
    path = f"{state.root}/fact/batch={number}"
    if target is None:
        write_fact(spark, packed, path, lambda dealt: unpacked_fact(dealt, cfg.surrogate_null_token, MONTH))
        written = spark.read.parquet(path).select(MONTH).distinct().collect()  # one row a month
        months = {r[0]: number for r in written}
    else:
        # incremental runs only: defensive one-row-per-key pass over the
        # (look-back sized) batch, refuse schema drift, and write the batch
        # once: it is read twice (touched months, then the merge)
        batch = keep_latest(batch, "order_item_id")
        assert_same_schema(target, batch)
        batch = wh.materialize(batch, "fact-batch")
        touched = batch_months(batch)
        if touched:
            # a key hashes the invoice time, so it lies in one month: the other months stay
            old = fact(spark, state, touched)
            write_fact(spark, upsert_by_key(old, batch, "order_item_id"), path)
        months = state.months | {m: number for m in touched}
    state.batch, state.months = number, months
    save_state(spark, state, batch_ts)
    return BatchOutputs(stg, om, cm, pm, calendar, batch)


def current_customers(state: BuildState) -> DataFrame:
    return current_rows(state.customers.all(), CUSTOMER_SNAPSHOT_COLUMNS)


def current_products(state: BuildState) -> DataFrame:
    return current_rows(state.products.all(), PRODUCT_SNAPSHOT_COLUMNS)


def fact(spark: SparkSession, state: BuildState, months: list[int] | None = None) -> DataFrame:
    """The current fact rows (of ``months`` only): of each month the files of the
    batch that wrote it last, which partition pruning picks."""
    if not state.fact_exists:
        raise ValueError("fact has not been built")
    wanted = {m: n for m, n in state.months.items() if months is None or m in months}
    current = F.lit(False)
    for n in sorted(set(wanted.values())):
        current |= (F.col("batch") == n) & F.col(MONTH).isin([m for m in wanted if wanted[m] == n])
    return spark.read.parquet(f"{state.root}/fact").filter(current).drop(MONTH, "batch")


def cut_before(raw_or_lines: DataFrame, cut: dt.date | None, ts_col: str) -> DataFrame:
    """Rows with ``ts_col`` before ``cut`` (text or timestamp column)."""
    if cut is None:
        return raw_or_lines
    return raw_or_lines.filter(F.col(ts_col).try_cast("timestamp_ntz")
                               < ts_lit(cut))
