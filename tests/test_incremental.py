"""The build by deltas and the snapshots it is stored in."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.config import PipelineConfig
from starmart.operators import metrics
from starmart.operators.staging import clean_order_lines
from starmart.plans import incremental as inc
from starmart.sources.driver_tables import dirty_order_lines, raw_order_lines
from starmart.sources.snapshots import Conflict, Folder, SnapshotStore

from .conftest import SMOKE

RAW = "invoice_no string, stock_code string, description string, quantity string, invoice_date string, unit_price string, customer_id string, country string"


def same(a, b):
    b = b.select(*a.columns)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def three_batches(spark, tmp_path_factory):
    """Faulty lines in three batches, out of order, lines with two descriptions split over batches, one batch sent twice."""
    raw = dirty_order_lines(spark, SMOKE).cache()
    spare = F.col("description").endswith("(spare) ").cast("int")
    part = F.pmod(F.hash("invoice_no", "stock_code") + F.coalesce(spare, F.lit(0)), F.lit(3))
    root = str(tmp_path_factory.mktemp("warehouse"))
    for i, day in ((0, 1), (2, 2), (1, 3), (2, 4)):
        inc.apply_batch(spark, raw.where(part == i), dt.datetime(2001, 8, day), root)
    return raw, root


def test_metrics_of_batches_equal_metrics_of_all(spark, three_batches):
    raw, root = three_batches
    stg = clean_order_lines(raw).cache()
    same(inc.lines(spark, root), stg)
    same(inc.metrics_now(spark, root, "customer"), metrics.customer_metrics(stg))
    same(inc.metrics_now(spark, root, "product"), metrics.product_metrics(stg))
    same(inc.metrics_now(spark, root, "order"), metrics.order_metrics(stg))


def test_compaction_changes_no_row(spark, three_batches):
    _, root = three_batches
    store = SnapshotStore(spark, root)
    before = store.load()
    read = {"lines": inc.lines(spark, root), "fact": inc.fact(spark, root), **{w: inc.metrics_now(spark, root, w) for w in ("order", "customer", "product")}}
    read = {k: v.collect() for k, v in read.items()}
    after = inc.compact(spark, root)
    assert after.number == before.number + 1 and all(len(after.relations[n]) == 1 for n in ("lines", "fact", *inc.LOG_KEYS))
    now = {"lines": inc.lines(spark, root), "fact": inc.fact(spark, root), **{w: inc.metrics_now(spark, root, w) for w in ("order", "customer", "product")}}
    assert {k: sorted(map(str, v)) for k, v in read.items()} == {k: sorted(map(str, v.collect())) for k, v in now.items()}
    # the snapshot before still reads; vacuum takes it away and nothing that the new one names
    assert inc.fact(spark, root, before).count() == len(read["fact"])
    assert f"snapshots/{before.number}.json" in store.vacuum(1) and store.numbers() == [after.number]
    assert inc.fact(spark, root).count() == len(read["fact"])


def line(invoice, stock, day, description="a thing", quantity="2", price="1.50", customer="c1"):
    return (invoice, stock, description, quantity, f"2020-{day} 10:00:00", price, customer, "X")


def test_replaced_late_and_repeated_lines(spark, tmp_path):
    root = str(tmp_path / "w")

    def batch(rows, day):
        return inc.apply_batch(spark, spark.createDataFrame(rows, RAW), dt.datetime(2020, 3, day), root)

    first = [line("1", "p", "01-10"), line("1", "q", "01-10", price="9.00"), line("2", "p", "02-20", customer="c2", quantity="many")]
    batch(first, 1)
    # a longer description and another price win; an older line comes too late for the fact; invoice 1 spans a month
    second = [line("2", "p", "02-20", "a longer thing", "5", "3.00", "c2"), line("1", "p", "01-10"), line("3", "p", "01-05", customer="c2"),
              line("1", "p", "02-21"), line("1", "p", "02-21")]
    batch(second, 2)
    third = batch(second, 3)
    assert spark.read.schema(inc.SCHEMAS["products"]).parquet(f"{root}/{third.relations['products'][-1].path}").isEmpty()
    stg = clean_order_lines(spark.createDataFrame(first + second, RAW))
    for which, all_at_once in (("customer", metrics.customer_metrics), ("product", metrics.product_metrics), ("order", metrics.order_metrics)):
        same(inc.metrics_now(spark, root, which), all_at_once(stg))
    got = {(r.invoice_no, r.invoice_date.day): (r.quantity, float(r.unit_price)) for r in inc.fact(spark, root).where("product_key = md5('p')").collect()}
    assert got == {("1", 10): (2, 1.5), ("2", 20): (5, 3.0), ("1", 21): (2, 1.5)}
    prices = {r.stock_code: (r.min_price, r.max_price) for r in inc.metrics_now(spark, root, "product").collect()}
    assert prices == {"p": (1.5, 3.0), "q": (9.0, 9.0)}
    versions = inc.history(spark, root, "customer_history").where("customer_id = 'c1'").orderBy("dbt_valid_from").collect()
    assert [v.total_items for v in versions] == [2, 3] and versions[0].dbt_valid_to == dt.datetime(2020, 3, 2)


def test_a_day_reads_and_writes_what_it_touches(spark, tmp_path):
    raw, root = raw_order_lines(spark, SMOKE), str(tmp_path / "w")
    day = F.col("invoice_date").try_cast("timestamp_ntz")
    cut = dt.datetime(2000, 1, 10)
    base = inc.apply_batch(spark, raw.where(day < F.lit(cut)), cut, root)
    store = SnapshotStore(spark, root)
    after = inc.apply_batch(spark, raw.where((day >= F.lit(cut)) & (day < F.lit(cut + dt.timedelta(days=1)))), cut + dt.timedelta(days=1), root)
    new = {n: [f for f in after.relations[n] if f not in base.relations[n]] for n in ("lines", "fact", "bills")}
    assert all(set(f.months or ()) <= {200001} for folders in new.values() for f in folders)
    rows = sum(spark.read.schema(inc.SCHEMAS["fact"]).parquet(f"{root}/{f.path}").count() for f in new["fact"] if f.kind == "rows")
    assert 0 < rows < 40 < inc.fact(spark, root, base).count()
    assert sum(store.bytes_of(f) for f in new["fact"]) < 0.2 * sum(store.bytes_of(f) for f in base.relations["fact"])
    # lines of other months are in folders that the batch's read prunes
    stored = store.read(base, "lines", inc.SCHEMAS["lines"], inc.KEY, [200001], inc.STAGING_MONTH)
    plan = stored._jdf.queryExecution().simpleString()
    assert "PartitionFilters: [" in plan and "200001" in plan[plan.index("PartitionFilters: ["):]
    assert {r[0] for r in stored.select(inc.STAGING_MONTH).distinct().collect()} == {200001}


def test_second_writer_loses_and_a_dead_run_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path / "w")
    store = SnapshotStore(spark, root)
    empty = store.load()
    assert empty.number == 0 and store.numbers() == []
    inc.apply_batch(spark, spark.createDataFrame([line("1", "p", "01-10")], RAW), dt.datetime(2020, 3, 1), root)
    base = store.load()
    # a run that dies before its commit: folders without a snapshot
    dead = store.write(spark.createDataFrame([("x", 1)], "stock_code string, n int"), "names")
    assert store.load() == base and inc.fact(spark, root).count() == 1
    inc.apply_batch(spark, spark.createDataFrame([line("2", "p", "01-11")], RAW), dt.datetime(2020, 3, 2), root)
    with pytest.raises(Conflict):
        inc.apply_batch(spark, spark.createDataFrame([line("3", "p", "01-11")], RAW), dt.datetime(2020, 3, 2), root, base=base)
    with pytest.raises(Conflict):
        store.commit(base, {"fact": [Folder("nowhere")]})
    assert store.numbers() == [1, 2] and inc.fact(spark, root).count() == 2 and inc.fact(spark, root, store.load(1)).count() == 1
    gone = store.vacuum(2)
    assert dead.path in gone and store.numbers() == [1, 2] and inc.fact(spark, root, store.load(1)).count() == 1


def test_a_batch_without_new_lines(spark, tmp_path):
    root = str(tmp_path / "w")
    none = spark.createDataFrame([], RAW)
    assert inc.apply_batch(spark, none, dt.datetime(2020, 3, 1), root).number == 1
    inc.apply_batch(spark, spark.createDataFrame([line("1", "p", "01-10")], RAW), dt.datetime(2020, 3, 2), root)
    inc.apply_batch(spark, none, dt.datetime(2020, 3, 3), root)
    assert inc.fact(spark, root).count() == 1 and inc.history(spark, root, "customer_history").count() == 1
    rebuilt = inc.apply_batch(spark, spark.createDataFrame([line("2", "q", "01-10")], RAW), dt.datetime(2020, 3, 4), root, PipelineConfig(), True)
    assert rebuilt.number == 4 and [r.invoice_no for r in inc.fact(spark, root).collect()] == ["2"]


def test_checks_run_over_new_lines_only(spark, tmp_path):
    from starmart.plans import check_runs

    root, as_of = str(tmp_path / "w"), dt.datetime(2020, 2, 1)

    def batch(rows, day):
        inc.apply_batch(spark, spark.createDataFrame(rows, RAW), dt.datetime(2020, 3, day), root)
        check_runs.check_new_lines(spark, root, as_of, dt.datetime(2020, 3, day))

    batch([line("1", "p", "01-10"), line("2", "p", "01-11", quantity="0"), line("3", "p", "02-20", quantity="many")], 1)
    first = {(r.check_id, r.order_item_id) for r in check_runs.current_failures(spark, root).collect()}
    assert {c for c, _ in first} == {"expression_is_true__staging__quantity", "not_null__staging__quantity", "not_null__staging__is_return",
                                     "not_in_future__staging__invoice_date"}
    # the line without a quantity is replaced by a good one; it is still in the future
    batch([line("3", "p", "02-20", "a longer thing"), line("4", "p", "01-12", "")], 2)
    runs = {(r.run_ts.day, r.check_id): (r.rows_checked, r.failures) for r in check_runs.results(spark, root).collect()}
    assert runs[1, "not_null__staging__quantity"] == (3, 1) and runs[2, "not_null__staging__quantity"] == (2, 0)
    now = sorted(r.check_id for r in check_runs.current_failures(spark, root).collect())
    assert now == ["expression_is_true__staging__quantity", "not_in_future__staging__invoice_date"]
    check_runs.check_new_lines(spark, root, as_of, dt.datetime(2020, 3, 3))
    assert {r.rows_checked for r in check_runs.results(spark, root).where("day(run_ts) = 3").collect()} == {0}


def test_a_first_batch_is_written_once_and_not_compared(spark, tmp_path):
    import pathlib

    kept = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def copies():
        return {p.name for name in ("batch-lines", "line-changes") for p in kept.glob(f"{name}-*")}

    root, before = str(tmp_path / "w"), copies()
    twice = [line("1", "p", "01-10"), line("1", "p", "01-10", "a longer thing"), line("2", "p", "02-20")]
    inc.apply_batch(spark, spark.createDataFrame(twice, RAW), dt.datetime(2020, 3, 1), root)
    assert copies() == before  # the lines went into the warehouse, nowhere else
    # a batch of other months is written, and compared with nothing
    inc.apply_batch(spark, spark.createDataFrame([line("3", "p", "04-10")], RAW), dt.datetime(2020, 5, 1), root)
    assert {n.rsplit("-", 1)[0] for n in copies() - before} == {"batch-lines"}
    assert sorted(r.description for r in inc.lines(spark, root).collect()) == ["a longer thing", "a thing", "a thing"]
    same(inc.lines(spark, root), clean_order_lines(spark.createDataFrame(twice + [line("3", "p", "04-10")], RAW)))
