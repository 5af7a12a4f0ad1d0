"""The daily build by deltas: a batch costs what the batch touches.

``apply_batch`` takes only the raw lines that arrived since the last batch,
re-sent and late ones among them, and makes the next snapshot of a warehouse
folder (``sources.snapshots``):

* ``lines``: the cleaned line of every grain key, merge on read.  The batch is
  compared with the stored lines of the months it touches only (with none, if
  none are stored there: it is then dealt by month at once, and written there); a re-sent line replaces the stored one if it wins the
  staging order.  Within a month lines are dealt by invoice.
* Everything above is kept as sums of signed changes (+1 a line that came, -1
  the line it replaced): ``bills`` (invoice, customer, product), ``customers``,
  ``products``, ``prices`` (how often a product had a price) and ``names`` (how
  often it had a description), the last three from lines dealt once by product.
  Current values are sums over the log; least and
  greatest price are those with a count above 0, so a replaced line can be
  taken back.  A replacement keeps the grain, hence the dates, so first and
  last dates only ever merge.
* Distinct counts grow by what is new.  ``invoices`` says in which months an
  invoice has lines: bills are looked up in those months alone.  ``pairs`` holds
  the (product, customer) pairs seen.  Both are narrow key tables.
* Histories: the open version of every key is compared as before (recency
  changes for nearly everybody each day); closed versions are appended.
* ``fact``: changed lines within the look-back are joined to the versions that
  were open at its floor or later; replaced ones become deletes.  A line that
  comes later than that stays out.

What a batch reads of old data: lines and bills of the touched months, the two
key tables, and one row (a few after several batches) for each customer and
product.  It reads no fact.  ``compact`` folds logs and deletes.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from starmart.config import UNKNOWN_DESCRIPTION, PipelineConfig
from starmart.functions import forward_value, line_value, money, surrogate_key
from starmart.functions.dates import ts_lit
from starmart.operators import calendar as cal
from starmart.operators.dedup import keep_first
from starmart.operators.fact import FACT_COLUMNS, lookback_filter, packed_fact, unpacked_fact
from starmart.operators.metrics import segment
from starmart.operators.scd2 import PART, VALID_TO, snapshot_check
from starmart.operators.staging import GRAIN, STAGING_COLUMNS, line_order, typed_order_lines
from starmart.operators.temporal_join import SALTS, heavy_keys
from starmart.plans.build import CUSTOMER_SNAPSHOT_COLUMNS, PRODUCT_SNAPSHOT_COLUMNS, STAGING_MONTH, Warehouse
from starmart.session import PARQUET
from starmart.sources.snapshots import Folder, Snapshot, SnapshotStore
from starmart.sources.tables import MONTH, with_month

KEY = "order_item_id"
PACKED_KEY, _DEAL, _STEM = "__key", "__deal", "__stem"
LINES_A_TASK = (1 << 14, 1 << 18)       # lines of a batch that a task sums by product: at least, while that leaves tasks for the cluster; at most
PRODUCT_LOGS = ("products", "prices", "names")
PARTS_A_TASK = 4                        # parts that a batch's lines are dealt in, for each shuffle partition
_META = "dbt_scd_id string, dbt_updated_at timestamp_ntz, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz"
SCHEMAS = {
    "lines": "order_item_id string, invoice_no string, stock_code string, description string, quantity int, is_return boolean, "
             "invoice_date timestamp_ntz, invoice_date_only date, unit_price decimal(10,2), customer_id string, country string, invoice_month int",
    "invoices": "invoice_no string, invoice_month int",
    "bills": "invoice_no string, customer_id string, stock_code string, first_ts timestamp_ntz, lines long, qty long, qty_n long, "
             "net decimal(31,2), gross decimal(31,2), returns long, forward_lines long, invoice_month int",
    "pairs": "stock_code string, customer_id string",
    "customers": "customer_id string, orders long, lines long, qty long, qty_n long, net decimal(31,2), gross decimal(31,2), returns long, "
                 "first_ts timestamp_ntz, last_ts timestamp_ntz",
    "products": "stock_code string, orders long, buyers long, qty long, qty_n long, net decimal(31,2), gross decimal(31,2), returns long, "
                "price_sum decimal(31,2), price_n long",
    "prices": "stock_code string, unit_price decimal(10,2), n long",
    "names": "stock_code string, description string, n long",
    "customer_history": "customer_key string, customer_id string, total_orders long, total_revenue double, gross_revenue double, return_count long, "
                        "total_items long, total_quantity long, first_order_date timestamp_ntz, last_order_date timestamp_ntz, recency_days int, "
                        "customer_segment string, " + _META,
    "product_history": "product_key string, stock_code string, description string, order_count long, total_quantity_sold long, total_revenue double, "
                       "gross_revenue double, return_count long, unique_customers long, min_price double, max_price double, avg_price double, " + _META,
    "fact": "order_item_id string, customer_key string, product_key string, date_key int, invoice_date timestamp_ntz, invoice_no string, "
            "is_return boolean, quantity int, unit_price decimal(10,2), revenue decimal(22,2), country string, date_month int",
    "calendar": "date_key int, week_of_year int, full_date date, year int, month int, day int, quarter int, day_of_year int, day_name string, "
                "month_name string, is_weekend boolean, is_weekday boolean",
}
# fixed: the columns that identify a row of each log
LOG_KEYS = {"customers": ["customer_id"], "products": ["stock_code"], "prices": ["stock_code", "unit_price"], "names": ["stock_code", "description"],
            "bills": ["invoice_no", "customer_id", "stock_code", "invoice_month"]}
FACT_ORDER = ("date_key", "customer_key")
_LEAST, _GREATEST = ("first_ts",), ("last_ts",)


def _month(ts: str):
    return F.coalesce((F.year(ts) * 100 + F.month(ts)).cast("int"), F.lit(0))


def typed_batch(raw: DataFrame) -> DataFrame:
    """The typed lines of a batch, with their month."""
    return typed_order_lines(raw).withColumn(STAGING_MONTH, _month("invoice_date"))


def month_parts(spark: SparkSession, *counts: list[Row]) -> DataFrame:
    """Into how many parts each month's lines go (month, parts), from ``counts`` (month, n): much the same number of lines a part."""
    n = Counter()
    for rows in counts:
        n.update({r[STAGING_MONTH]: r["n"] for r in rows})
    share = PARTS_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions")) / max(1, sum(n.values()))
    return spark.createDataFrame([(m, math.ceil(k * share)) for m, k in n.items()], f"{STAGING_MONTH} int, parts int")


def _month_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(STAGING_MONTH).agg(F.count(F.lit(1)).alias("n"))


def _stem():
    """What stands before the first '-' of a line's key text: the invoice as a rule; lines of one key share it."""
    return F.substring_index("invoice_no", "-", 1)


def heavy_stems(spark: SparkSession, *lines: DataFrame) -> DataFrame:
    """The stems (``heavy_keys``) that hold too many lines for one part."""
    rows = reduce(DataFrame.unionByName, [df.select(_stem().alias(_STEM)) for df in lines])
    return heavy_keys(rows, _STEM, parts=max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _dealt(rows: DataFrame, key: Column, parts: DataFrame, heavy: DataFrame) -> DataFrame:
    """Lines dealt by month and part, so that a month is written from where its lines are.  The part is that of the stem, so
    that lines of an invoice stay together (what repeats in it is stored and dealt shorter), or of the whole ``key`` if the
    stem is ``heavy``.  Keys are hashes that no shuffle can shorten: they are made anew behind it (``PACKED_KEY``)."""
    rows = rows.join(F.broadcast(heavy.select(F.col(_STEM).alias("__heavy"))), _stem() == F.col("__heavy"), "left")
    by = F.when(F.col("__heavy").isNull(), F.xxhash64(_stem())).otherwise(F.xxhash64(key))
    part = F.pmod(by, F.coalesce("parts", F.lit(1))).cast("int")
    rows = rows.join(F.broadcast(parts), STAGING_MONTH, "left").withColumn(_DEAL, part).drop("parts", "__heavy").repartition(STAGING_MONTH, _DEAL)
    return rows.withColumn(PACKED_KEY, key).withColumn(_STEM, _stem())


def _packed_key(cfg: PipelineConfig):
    return F.unhex(surrogate_key(*GRAIN, null_token=cfg.surrogate_null_token))               # 16 bytes, not 32


def _line_columns() -> list:
    return [F.lower(F.hex(PACKED_KEY)).alias(KEY), "invoice_no", "stock_code", "description", "quantity", (F.col("quantity") < 0).alias("is_return"),
            "invoice_date", F.to_date("invoice_date").alias("invoice_date_only"), "unit_price", "customer_id", "country", STAGING_MONTH]


def batch_lines(typed: DataFrame, cfg: PipelineConfig, parts: DataFrame, heavy: DataFrame) -> DataFrame:
    """The cleaned lines of a typed batch, one a key (which hashes the grain, the date with it)."""
    rows = _dealt(typed, _packed_key(cfg), parts, heavy)
    return keep_first(rows, [STAGING_MONTH, _DEAL, _STEM, PACKED_KEY], line_order()).select(*_line_columns())


def new_lines(lines: DataFrame) -> DataFrame:
    """Changes of lines none of whose keys is stored."""
    return lines.select(F.lit(1).alias("sign"), F.lit(True).alias("fresh"), *SCHEMAS_COLUMNS["lines"])


def line_changes(typed: DataFrame, stored: DataFrame, cfg: PipelineConfig, parts: DataFrame, heavy: DataFrame) -> DataFrame:
    """What a typed batch changes in the ``stored`` lines (one a key) of its months: lines that come (``sign`` 1) and lines
    they replace (``sign`` -1); ``fresh``: the key was not there.  The staging order decides between the lines of a key; the
    stored one stays if they are equal in it.  Both are dealt once, and a month's changes stay where they are."""
    batch = typed.select("*", F.lit(None).cast("binary").alias("__stored"), F.lit(False).alias("__old"))
    there = stored.select(*typed.columns, F.unhex(KEY).alias("__stored"), F.lit(True).alias("__old"))
    by = [STAGING_MONTH, _DEAL, _STEM, PACKED_KEY]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*line_order(), F.col("__old").desc()))
    known = F.max("__old").over(Window.partitionBy(*by))
    key = F.coalesce("__stored", _packed_key(cfg))
    rows = _dealt(batch.unionByName(there), key, parts, heavy).select("*", place.alias("__place"), known.alias("__known"))
    won = F.col("__place") == 1
    return rows.where(won != F.col("__old")).select(
        F.when(won, 1).otherwise(-1).alias("sign"), (~F.col("__known")).alias("fresh"), *_line_columns())


def _signed() -> list:
    """Signed sums over changes, shared by bills, customers and products."""
    sign, money_type = F.col("sign"), "decimal(31,2)"
    return [F.sum(sign * F.col("quantity")).cast("long").alias("qty"),
            F.sum(F.when(F.col("quantity").isNotNull(), sign).otherwise(0)).cast("long").alias("qty_n"),
            F.sum(sign * line_value()).cast(money_type).alias("net"), F.sum(sign * forward_value()).cast(money_type).alias("gross"),
            F.sum(F.when(F.col("is_return"), sign).otherwise(0)).cast("long").alias("returns")]


def bill_rows(changes: DataFrame) -> DataFrame:
    """Rows of the ``bills`` log, one a change.  A bill seldom has a product twice, so summing them here would deal every
    line for next to nothing; readers sum the log by its key anyway."""
    sign, money_type = F.col("sign"), "decimal(31,2)"
    return changes.select(
        "invoice_no", "customer_id", "stock_code", F.col("invoice_date").alias("first_ts"), sign.cast("long").alias("lines"),
        (sign * F.col("quantity")).cast("long").alias("qty"),
        F.when(F.col("quantity").isNotNull(), sign).otherwise(0).cast("long").alias("qty_n"),
        (sign * line_value()).cast(money_type).alias("net"), (sign * forward_value()).cast(money_type).alias("gross"),
        F.when(F.col("is_return"), sign).otherwise(0).cast("long").alias("returns"),
        F.when(F.col("is_return"), 0).otherwise(sign).cast("long").alias("forward_lines"), STAGING_MONTH)


def _lines_sum():
    return F.sum("sign").cast("long").alias("lines")


def folded(name: str, log: DataFrame) -> DataFrame:
    """Current rows of a log: sums (and first or last dates) by its key."""
    key = LOG_KEYS[name]
    types = dict(log.dtypes)
    values = [c for c in log.columns if c not in key]
    if name in ("prices", "names"):  # a batch has a key once: dealt by product at once, as what is made of them is
        log = log.repartition("stock_code")
    return log.groupBy(*key).agg(*[(F.min if c in _LEAST else F.max if c in _GREATEST else F.sum)(c).cast(types[c]).alias(c) for c in values])


def _known(value: str):
    """A sum of quantities is NULL when no line has one."""
    return F.when(F.col("qty_n") > 0, F.col(value))


def _product_parts(spark: SparkSession, lines: int) -> int:
    few, many = (math.ceil(lines / n) for n in LINES_A_TASK)
    return max(1, many, min(few, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def product_logs(changes: DataFrame, known: DataFrame, pairs: DataFrame, hot: DataFrame, parts: int) -> DataFrame:
    """Rows of the logs ``products``, ``prices`` and ``names`` (``kind``) of a batch.  ``known``: rows of the bills of its
    invoices, ``pairs``: its new ones, ``hot``: the products (``heavy_keys``) that are spread by invoice; readers sum their rows.

    Changes are dealt once, by product, and summed there for all three.  An order of a product is new if one of its lines is
    ``fresh`` and no known bill has both, so known bills are dealt with the changes, without a sign."""
    rows = changes.select("stock_code", "invoice_no", "description", "unit_price", "quantity", "sign", "fresh").unionByName(
        known.select("stock_code", "invoice_no"), allowMissingColumns=True)
    heavy = F.broadcast(hot.select(F.col("stock_code").alias("__hot"), F.col(SALTS).alias("__salts")))
    salt = F.coalesce(F.pmod(F.xxhash64("invoice_no"), F.col("__salts")), F.lit(0)).cast("int")
    dealt = rows.join(heavy, F.col("stock_code") == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot", "__salts").repartition(
        parts, "stock_code", "__salt")
    each = dealt.withColumn("is_return", F.col("quantity") < 0).withColumn("kind", F.explode(F.array(*[F.lit(k) for k in PRODUCT_LOGS])))

    def of(kind: str, column: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(column))

    by, money_type = ["stock_code", "__salt", "kind"], "decimal(31,2)"
    bills = each.groupBy(*by, of("products", "invoice_no").alias("bill"), of("prices", "unit_price").alias("price"), of("names", "description").alias("name")).agg(
        *_signed(), F.sum(F.col("sign") * F.col("unit_price")).cast(money_type).alias("price_sum"), F.sum("sign").cast("long").alias("n"),
        (F.bool_or(F.coalesce("fresh", F.lit(False))) & ~F.bool_or(F.col("sign").isNull())).alias("new"))
    sums = bills.groupBy(*by, "price", "name").agg(
        F.count_if("new").alias("orders"), *[F.sum(c).cast("long").alias(c) for c in ("qty", "qty_n", "returns", "n")],
        *[F.sum(c).cast(money_type).alias(c) for c in ("net", "gross", "price_sum")])
    logs = sums.where((F.col("kind") == "products") & F.col("n").isNotNull() | (F.col("n") != 0)).select(
        "kind", "stock_code", "orders", F.lit(0).cast("long").alias("buyers"), "qty", "qty_n", "net", "gross", "returns", "price_sum",
        F.col("n").alias("price_n"), F.col("price").alias("unit_price"), F.col("name").alias("description"), "n")
    zero = [F.lit(0).cast("long").alias(c) for c in ("orders", "qty_n", "returns", "price_n")]
    buyers = pairs.groupBy("stock_code").agg(F.count(F.lit(1)).alias("buyers")).select(F.lit("products").alias("kind"), "stock_code", "buyers", *zero)
    return logs.unionByName(buyers, allowMissingColumns=True)


def customer_metrics(customers: DataFrame, max_date: dt.datetime, cfg: PipelineConfig) -> DataFrame:
    """Customer metrics from the folded ``customers`` log."""
    return customers.select(
        surrogate_key("customer_id", null_token=cfg.surrogate_null_token).alias("customer_key"), "customer_id",
        F.col("orders").alias("total_orders"), F.col("lines").alias("total_items"), _known("qty").alias("total_quantity"),
        money(_known("net")).alias("total_revenue"), money(F.col("gross")).alias("gross_revenue"), F.col("returns").alias("return_count"),
        F.col("first_ts").alias("first_order_date"), F.col("last_ts").alias("last_order_date"),
        F.datediff(ts_lit(max_date), "last_ts").alias("recency_days"),
        segment(F.col("customer_id"), F.col("orders"), F.col("gross"), cfg.thresholds).alias("customer_segment"))


def product_metrics(products: DataFrame, prices: DataFrame, names: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Product metrics from the folded logs."""
    span = prices.where("n > 0").groupBy("stock_code").agg(F.min("unit_price").alias("lo"), F.max("unit_price").alias("hi"))
    best = keep_first(names.where("n > 0"), ["stock_code"], [F.col("n").desc(), F.col("description").asc_nulls_last()])
    avg_cents = F.expr("(price_sum * 200 + price_n) div (price_n * 2)")
    return products.join(span, "stock_code").join(best.select("stock_code", "description"), "stock_code", "left").select(
        surrogate_key("stock_code", null_token=cfg.surrogate_null_token).alias("product_key"), "stock_code",
        F.coalesce("description", F.lit(UNKNOWN_DESCRIPTION)).alias("description"), F.col("orders").alias("order_count"),
        _known("qty").alias("total_quantity_sold"), money(_known("net")).alias("total_revenue"), money(F.col("gross")).alias("gross_revenue"),
        F.col("returns").alias("return_count"), F.col("buyers").alias("unique_customers"), money(F.col("lo")).alias("min_price"),
        money(F.col("hi")).alias("max_price"), (avg_cents / F.lit(100)).cast("decimal(20,2)").cast("double").alias("avg_price"))


def order_metrics(bills: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Order metrics from the ``bills`` log."""
    cfg = cfg or PipelineConfig()
    sums = [F.sum(c).alias(c) for c in ("lines", "qty", "qty_n", "net", "gross", "returns", "forward_lines")]
    items = bills.groupBy("invoice_no", "customer_id", "stock_code").agg(F.min("first_ts").alias("first_ts"), *sums)
    orders = items.groupBy("invoice_no", "customer_id").agg(F.min("first_ts").alias("first_ts"), F.count(F.lit(1)).alias("unique_items"), *sums)
    return orders.select(
        surrogate_key("invoice_no", "customer_id", null_token=cfg.surrogate_null_token).alias("order_key"), "invoice_no", "customer_id",
        F.col("first_ts").alias("order_date"), F.col("lines").alias("line_item_count"), "unique_items", _known("qty").alias("total_quantity"),
        F.col("forward_lines").alias("forward_item_count"), money(_known("net")).alias("total_order_value"),
        money(F.col("gross")).alias("forward_order_value"), F.when(F.col("qty_n") > 0, F.col("returns") > 0).alias("has_returns"))


def _count_new(fresh: DataFrame, keys: list[str], known: DataFrame, by: str, name: str) -> DataFrame:
    """How many distinct ``keys`` of the fresh lines are not known yet, for each ``by``."""
    new = fresh.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")
    return new.groupBy(by).agg(F.count(F.lit(1)).alias(name))


def _history(store: SnapshotStore, base: Snapshot, name: str, since: dt.datetime | None) -> DataFrame:
    """Open versions and those closed after ``since``."""
    open_rows = store.read(base, f"{name}_open", SCHEMAS[name])
    closed = store.read(base, f"{name}_closed", SCHEMAS[name])
    return open_rows.unionByName(closed if since is None else closed.where(F.col(VALID_TO) > ts_lit(since)))


def _next_history(store: SnapshotStore, base: Snapshot, name: str, source: DataFrame, key: str, check: tuple[str, ...],
                  batch_ts: dt.datetime) -> dict[str, list[Folder]]:
    there = f"{name}_open" in base
    step = snapshot_check(store.read(base, f"{name}_open", SCHEMAS[name]) if there else None, source, key, check, batch_ts)
    path = store.fresh(name)
    step.combined.write.options(**PARQUET).partitionBy(PART).parquet(f"{store.root}/{path}")
    closed = list(base.relations.get(f"{name}_closed", ()))
    if store.holds(f"{path}/{PART}=closed"):
        closed.append(Folder(f"{path}/{PART}=closed"))
    return {f"{name}_open": [Folder(f"{path}/{PART}=open")] if store.holds(f"{path}/{PART}=open") else [], f"{name}_closed": closed}


def apply_batch(spark: SparkSession, raw: DataFrame, batch_ts: dt.datetime, root: str, cfg: PipelineConfig | None = None,
                full_refresh: bool = False, base: Snapshot | None = None, properties: dict | None = None,
                also: dict[str, list[Folder]] | None = None, stored: bool = False) -> Snapshot:
    """Apply the raw lines of one batch; returns the new snapshot (with ``properties`` on it, and relations ``also``).  ``stored``: they are read
    from files, so typing them again costs less than writing them typed.  Raises ``snapshots.Conflict`` if another writer was faster."""
    cfg, wh, store = cfg or PipelineConfig(), Warehouse(spark), SnapshotStore(spark, root)
    base = base or store.load()
    if full_refresh:
        base = Snapshot(base.number)
    number, out, props = base.number + 1, dict(also or {}), dict(base.properties)
    props |= {**(properties or {}), "batch_ts": batch_ts.isoformat()}

    def old(name: str, **how) -> DataFrame:
        return store.read(base, name, SCHEMAS[name], **how)

    def add(name: str, df: DataFrame, **how) -> None:
        out[name] = [*out.get(name, base.relations.get(name, ())), store.write(df, name, **how)]

    typed = typed_batch(raw)
    if "lines" in base and not stored:  # typed once, for its months and its lines
        typed = wh.materialize(typed, "batch-lines")
    sizes = _month_counts(typed).collect()                                                # one row a month
    months = [r[STAGING_MONTH] for r in sizes]
    if not months:  # no line at all
        return store.commit(base, out, props)
    overlaps = any(set(f.months or ()) & set(months) for f in base.relations.get("lines", ()))
    if overlaps:
        known = old("lines", key=KEY, months=months, month=STAGING_MONTH)
        held = old("lines", months=months, month=STAGING_MONTH)         # replaced ones too: for counts that only say how lines are dealt
        there = _month_counts(held).collect()
        changes = wh.materialize(line_changes(typed, known, cfg, month_parts(spark, sizes, there), heavy_stems(spark, typed, held)), "line-changes", partition_by=(STAGING_MONTH,))
        came = changes.where("sign = 1")
        add("lines", came.select(*SCHEMAS_COLUMNS["lines"]), seq=number, month=STAGING_MONTH, laid=True)
        add("lines", changes.where("sign = -1").select(KEY, STAGING_MONTH), seq=number, kind="deletes", month=STAGING_MONTH, laid=True)
    else:  # every line is new: what is stored is what is read from here on
        add("lines", batch_lines(typed, cfg, month_parts(spark, sizes), heavy_stems(spark, typed)), seq=number, month=STAGING_MONTH, laid=True)
        came = changes = new_lines(store.read(Snapshot(number, {"lines": tuple(out["lines"][-1:])}), "lines", SCHEMAS["lines"]))
    gone, fresh = changes.where("sign = -1"), changes.where("fresh")

    # what is known of the batch's invoices: only the months in which they have lines are read
    touched = fresh.select("invoice_no").distinct()
    index = old("invoices")
    if "invoices" in base:
        ends = fresh.agg(F.min("invoice_no"), F.max("invoice_no")).first()
        if ends[0] is not None:
            index = index.where(F.col("invoice_no").between(ends[0], ends[1]))       # pushed to the files' statistics
        index = wh.materialize(index.join(touched, "invoice_no", "left_semi"), "known-invoices")
    bill_months = [r[0] for r in index.select(STAGING_MONTH).distinct().collect()]
    bills = wh.materialize(old("bills", months=bill_months, month=STAGING_MONTH).join(touched, "invoice_no", "left_semi").select(
        "invoice_no", "customer_id", "stock_code"), "known-bills")
    add("invoices", fresh.select("invoice_no", STAGING_MONTH).distinct().join(index, ["invoice_no", STAGING_MONTH], "left_anti"))
    known_pairs = old("pairs").join(fresh.select("stock_code", "customer_id").distinct(), ["stock_code", "customer_id"], "left_semi")
    pairs = wh.materialize(fresh.select("stock_code", "customer_id").distinct().join(
        known_pairs, ["stock_code", "customer_id"], "left_anti"), "new-pairs")
    add("pairs", pairs)
    add("bills", bill_rows(changes), month=STAGING_MONTH, laid=True)  # read from files of one month each

    customers = changes.groupBy("customer_id").agg(_lines_sum(), *_signed(), F.min("invoice_date").alias("first_ts"),
                                                   F.max("invoice_date").alias("last_ts"))
    orders = _count_new(fresh, ["invoice_no", "customer_id"], bills, "customer_id", "orders")
    add("customers", customers.join(orders, "customer_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0))).select(
        *SCHEMAS_COLUMNS["customers"]))
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot_stock = wh.materialize(heavy_keys(changes, "stock_code", parts=parts), "hot-products")
    path = store.fresh("product_logs")
    product_logs(changes, bills, pairs, hot_stock, _product_parts(spark, sum(r["n"] for r in sizes))).write.options(**PARQUET).partitionBy(
        "kind").parquet(f"{store.root}/{path}")
    for name in PRODUCT_LOGS:
        if store.holds(f"{path}/kind={name}"):
            out[name] = [*base.relations.get(name, ()), Folder(f"{path}/kind={name}")]
        else:  # nothing changed: an empty folder, as for other relations
            add(name, spark.createDataFrame([], SCHEMAS[name]))

    now = Snapshot(number, {**base.relations, **{k: tuple(v) for k, v in out.items()}})
    span = changes.agg(F.min("invoice_date_only"), F.max("invoice_date_only"), F.max("invoice_date")).first()
    if span[0] is not None:
        lo, hi = min(str(span[0]), props.get("first_day", "9999-12-31")), max(str(span[1]), props.get("last_day", "0001-01-01"))
        if (lo, hi) != (props.get("first_day"), props.get("last_day")):
            pad = dt.timedelta(days=cfg.calendar_pad_days)
            days = cal.calendar_between(spark, dt.date.fromisoformat(lo) - pad, dt.date.fromisoformat(hi) + pad)
            out["calendar"] = [store.write(days, "calendar")]
            now = Snapshot(number, {**now.relations, "calendar": tuple(out["calendar"])})
        props.update(first_day=lo, last_day=hi, last_time=max(span[2].isoformat(), props.get("last_time", "")))
    if "last_time" in props:  # else no line has come yet
        newest = dt.datetime.fromisoformat(props["last_time"])
        cm = wh.materialize(customer_metrics(folded("customers", store.read(now, "customers", SCHEMAS["customers"])), newest, cfg), "customer-metrics")
        pm = wh.materialize(product_metrics(*(folded(n, store.read(now, n, SCHEMAS[n])) for n in ("products", "prices", "names")), cfg), "product-metrics")
        out |= _next_history(store, base, "customer_history", cm.select(*CUSTOMER_SNAPSHOT_COLUMNS), "customer_id", cfg.customer_check_cols, batch_ts)
        out |= _next_history(store, base, "product_history", pm.select(*PRODUCT_SNAPSHOT_COLUMNS), "stock_code", cfg.product_check_cols, batch_ts)
        now = Snapshot(number, {**now.relations, **{k: tuple(v) for k, v in out.items()}})

        target = dt.datetime.fromisoformat(props["fact_time"]) if "fact_time" in props else None
        floor = None if target is None else target - dt.timedelta(days=cfg.lookback_days)
        todo = came if target is None else lookback_filter(came, target, cfg.lookback_days)
        hot = [wh.materialize(heavy_keys(todo, k, parts=parts), f"hot-{k}") for k in ("customer_id", "stock_code")]
        rows = packed_fact(todo, _history(store, now, "customer_history", floor), _history(store, now, "product_history", floor),
                           store.read(now, "calendar", SCHEMAS["calendar"]), *hot)
        add("fact", with_month(rows), seq=number, month=MONTH, sort=FACT_ORDER,
            finish=lambda dealt: unpacked_fact(dealt, cfg.surrogate_null_token, MONTH))
        if target is not None:
            taken = lookback_filter(gone, target, cfg.lookback_days).select(KEY, F.col(STAGING_MONTH).alias(MONTH))
            add("fact", taken, seq=number, kind="deletes", month=MONTH)
        newest_fact = todo.agg(F.max("invoice_date")).first()[0]
        if newest_fact is not None:
            props["fact_time"] = max(newest_fact.isoformat(), props.get("fact_time", ""))
    return store.commit(base, out, props)


def fact(spark: SparkSession, root: str, snapshot: Snapshot | None = None, months: list[int] | None = None) -> DataFrame:
    """The fact as of a snapshot (the newest by default); of ``months`` only, if given."""
    store = SnapshotStore(spark, root)
    return store.read(snapshot or store.load(), "fact", SCHEMAS["fact"], KEY, months, MONTH).select(*FACT_COLUMNS)


def lines(spark: SparkSession, root: str, snapshot: Snapshot | None = None) -> DataFrame:
    store = SnapshotStore(spark, root)
    return store.read(snapshot or store.load(), "lines", SCHEMAS["lines"], KEY, None, STAGING_MONTH).select(*STAGING_COLUMNS)


def metrics_now(spark: SparkSession, root: str, which: str, cfg: PipelineConfig | None = None) -> DataFrame:
    """Order, customer or product metrics of the newest snapshot."""
    cfg, store = cfg or PipelineConfig(), SnapshotStore(spark, root)
    now = store.load()

    def log(name: str) -> DataFrame:
        return store.read(now, name, SCHEMAS[name])

    if which == "order":
        return order_metrics(log("bills"), cfg)
    if which == "customer":
        return customer_metrics(folded("customers", log("customers")), dt.datetime.fromisoformat(now.properties["last_time"]), cfg)
    return product_metrics(folded("products", log("products")), folded("prices", log("prices")), folded("names", log("names")), cfg)


def history(spark: SparkSession, root: str, name: str, snapshot: Snapshot | None = None) -> DataFrame:
    store = SnapshotStore(spark, root)
    return _history(store, snapshot or store.load(), name, None)


def calendar_now(spark: SparkSession, root: str) -> DataFrame:
    """The calendar of the newest snapshot; of the fixed fallback span while no line has been loaded."""
    store = SnapshotStore(spark, root)
    now = store.load()
    if "calendar" not in now:
        return cal.calendar(cal.calendar_fallback(spark))
    return store.read(now, "calendar", SCHEMAS["calendar"])


def compact(spark: SparkSession, root: str) -> Snapshot:
    """Fold logs to one row a key, and deletes into their relations; a snapshot like others, readers see no difference."""
    store = SnapshotStore(spark, root)
    base = store.load()
    out: dict[str, list[Folder]] = {}
    for name, month in (("lines", STAGING_MONTH), ("fact", MONTH)):
        if name in base:
            rows = store.read(base, name, SCHEMAS[name], KEY, None, month)
            out[name] = [store.write(rows, name, seq=base.number + 1, month=month, sort=FACT_ORDER if name == "fact" else ())]
    for name in LOG_KEYS:
        if name in base:
            rows = folded(name, store.read(base, name, SCHEMAS[name])).select(*SCHEMAS_COLUMNS[name])
            out[name] = [store.write(rows, name, month=STAGING_MONTH if name == "bills" else None)]
    for name in ("invoices", "pairs"):
        if name in base:
            out[name] = [store.write(store.read(base, name, SCHEMAS[name]), name)]
    return store.commit(base, out)


SCHEMAS_COLUMNS = {name: [part.split()[0] for part in ddl.replace("(31,2)", "").replace("(22,2)", "").replace("(10,2)", "").split(", ")]
                   for name, ddl in SCHEMAS.items()}
