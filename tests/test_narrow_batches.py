"""What a batch deals: keys are made after the last shuffle, a month is written from where its lines are."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.config import PipelineConfig
from starmart.operators import metrics
from starmart.operators.fact import sales_fact
from starmart.operators.staging import clean_order_lines
from starmart.operators.temporal_join import heavy_keys
from starmart.plans import incremental as inc
from starmart.sources.snapshots import SnapshotStore

from .test_incremental import RAW, line, same


def written(monkeypatch):
    """Columns and options of each relation written from here on."""
    seen, write = {}, SnapshotStore.write

    def spy(self, df, name, **how):
        seen.setdefault(name, []).append((set(df.columns), how))
        return write(self, df, name, **how)

    monkeypatch.setattr(SnapshotStore, "write", spy)
    return seen


def test_fact_is_dealt_without_hex_keys(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "w"), written(monkeypatch)
    rows = [line("1", "p", "01-10"), line("1", "p", "01-10", "a longer thing"), line("2", "q", "02-20", quantity="-3"), line("3", "p", "02-21", quantity="many")]
    inc.apply_batch(spark, spark.createDataFrame(rows, RAW), dt.datetime(2020, 3, 1), root)
    inc.apply_batch(spark, spark.createDataFrame([line("4", "q", "04-10")], RAW), dt.datetime(2020, 5, 1), root)
    assert [c & {"order_item_id", "is_return", "revenue"} for c, how in seen["fact"] if "kind" not in how] == [set(), set()]
    assert all(how.get("laid") for name in ("lines", "bills") for _, how in seen[name])  # dealt by month at once
    stg = clean_order_lines(spark.createDataFrame([*rows, line("4", "q", "04-10")], RAW))
    same(inc.lines(spark, root), stg)
    histories = [inc.history(spark, root, f"{n}_history") for n in ("customer", "product")]
    same(inc.fact(spark, root), sales_fact(stg, *histories, inc.calendar_now(spark, root)))
    assert inc.fact(spark, root).where(F.col("customer_key") == "-1").count() == 0


def test_changes_of_stored_months_are_dealt_once(spark, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "w"), written(monkeypatch)
    loads = [[line("1", "p", "01-10"), line("2", "p", "01-11"), line("3", "q", "02-01", None), line("4", "q", "bad date")],
             # replaced twice over, equal, shorter, null and not null, without a date, new, in a month of its own
             [line("1", "p", "01-10", "a longer thing"), line("1", "p", "01-10", "the longest thing"), line("2", "p", "01-11"), line("3", "q", "02-01", "named"),
              line("4", "q", "bad date"), line("5", "q", "01-12"), line("6", "q", "06-01")],
             [line("1", "p", "01-10", "short"), line("3", "q", "02-01", None)]]
    for i, rows in enumerate(loads):
        inc.apply_batch(spark, spark.createDataFrame(rows, RAW), dt.datetime(2020, 7, i + 1), root)
        stg = clean_order_lines(spark.createDataFrame([x for load in loads[:i + 1] for x in load], RAW))
        same(inc.lines(spark, root), stg)
        same(inc.metrics_now(spark, root, "order"), metrics.order_metrics(stg))
        same(inc.metrics_now(spark, root, "product"), metrics.product_metrics(stg))
    assert all(how.get("laid") for name in ("lines", "bills") for _, how in seen[name])
    store = SnapshotStore(spark, root)
    assert store.deleted(store.load(), "lines", "order_item_id").count() == 2


def plan_parts(spark, df, operator):
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [part for part in plan.split("\n\n") if part.split("\n")[0].endswith(f") {operator}")]


def test_lines_are_dealt_by_invoice_without_their_keys(spark):
    cfg = PipelineConfig()
    # "A-<n>" share a stem, which is heavy; ("9-8", "7") and ("9", "8-7") share their key text
    rows = [line(f"A-{i}", "p", "01-10") for i in range(90)] + [line(str(i // 10), f"s{i}", "01-11") for i in range(100)]
    rows += [line("9-8", "7", "01-12"), line("9", "8-7", "01-12", "a longer thing"), line("3", "s30", "01-11", "a longer thing")]
    typed = inc.typed_batch(spark.createDataFrame(rows, RAW))
    heavy = inc.heavy_stems(spark, typed)
    assert "A" in [r[0] for r in heavy.collect()]
    parts = spark.createDataFrame([(202001, 16)], "invoice_month int, parts int")
    out = inc.batch_lines(typed, cfg, parts, heavy.where("__stem = 'A'"))
    assert not any("__key#" in part for part in plan_parts(spark, out, "Exchange"))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = out.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(out) == 191 and len({r.order_item_id for r in out}) == 191
    tasks = {}
    for r in out:
        tasks.setdefault(r.invoice_no[:1], set()).add(r.task)
    assert len(tasks.pop("A")) > 1 and all(len(t) == 1 for t in tasks.values())


def test_product_logs_deal_changes_once(spark, tmp_path):
    rows = [line(str(i % 20), "p" if i % 3 else f"q{i % 7}", "01-10", f"thing {i % 4}", quantity=("2", "many", "-1")[i % 3]) for i in range(200)]
    root = str(tmp_path / "w")
    typed = inc.typed_batch(spark.createDataFrame(rows, RAW))
    parts = spark.createDataFrame([(202001, 2)], "invoice_month int, parts int")
    changes = inc.new_lines(inc.batch_lines(typed, PipelineConfig(), parts, inc.heavy_stems(spark, typed)))
    none = spark.createDataFrame([], "invoice_no string, customer_id string, stock_code string")
    hot = spark.createDataFrame([("p", 4)], "stock_code string, salts int")          # a product spread over several tasks
    logs = inc.product_logs(changes, none, none.select("stock_code", "customer_id"), hot, 3)
    assert sum("stock_code" in part and "sign" in part for part in plan_parts(spark, logs, "Exchange")) == 1
    # the same sums, whichever product is spread, as from the cleaned lines
    stg = clean_order_lines(spark.createDataFrame(rows, RAW))
    n = {(r.stock_code, r.description): r.n for r in logs.where("kind = 'names'").groupBy("stock_code", "description").agg(F.sum("n").alias("n")).collect()}
    assert n == {(r.stock_code, r.description): r["count"] for r in stg.groupBy("stock_code", "description").count().collect()}
    orders = {r.stock_code: r.n for r in logs.where("kind = 'products'").groupBy("stock_code").agg(F.sum("orders").alias("n")).collect()}
    assert orders == {r.stock_code: r.n for r in stg.groupBy("stock_code").agg(F.countDistinct("invoice_no").alias("n")).collect()}
    inc.apply_batch(spark, spark.createDataFrame(rows[:120], RAW), dt.datetime(2020, 3, 1), root)
    inc.apply_batch(spark, spark.createDataFrame(rows[100:], RAW), dt.datetime(2020, 3, 2), root)
    same(inc.metrics_now(spark, root, "product"), metrics.product_metrics(stg))
    inc.compact(spark, root)
    inc.apply_batch(spark, spark.createDataFrame([line("21", "p", "02-10", "thing 9")], RAW), dt.datetime(2020, 3, 3), root)
    same(inc.metrics_now(spark, root, "product"), metrics.product_metrics(clean_order_lines(spark.createDataFrame([*rows, line("21", "p", "02-10", "thing 9")], RAW))))


def test_heavy_keys_count_only_rows_of_heavy_buckets(spark):
    rows = spark.range(400).select(F.when(F.col("id") < 40, "a").when(F.col("id") < 60, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    hot = heavy_keys(rows, "k", parts=20)
    assert {(r.k, r.salts) for r in hot.collect()} == {("a", 2), (None, 1)}
    assert any("__hot_bucket" in part for part in plan_parts(spark, hot, "BroadcastHashJoin"))
