"""Hash keys are dealt as bytes, and come back as they were."""

from pyspark.sql import functions as F

from starmart.operators.checks import Check, failing_rows
from starmart.session import scratch_path
from starmart.sources.tables import read_fact, write_fact

from .conftest import SMOKE

HASH = "0123456789abcdef" * 2


def test_fact_keys_are_dealt_as_bytes(spark):
    rows = [(HASH, "-1", HASH[::-1], 20010203, 1), ("x", HASH, "p1", 20010204, 2), (HASH.upper(), "", "-1", 20010301, 3)]
    fact = spark.createDataFrame(rows, "order_item_id string, customer_key string, product_key string, date_key int, quantity int")
    at = scratch_path(spark, "narrow-fact")
    write_fact(spark, fact, at)
    assert sorted(map(tuple, read_fact(spark, at).select(*fact.columns).collect())) == sorted(rows)
    at = scratch_path(spark, "narrow-fact")
    write_fact(spark, fact.drop("order_item_id"), at, lambda dealt: dealt.withColumn("order_item_id", F.concat("customer_key", F.lit("/"), "quantity")))
    assert sorted(r.order_item_id for r in read_fact(spark, at).collect()) == ["-1/1", "/3", f"{HASH}/2"]


def test_checks_deal_keys_as_bytes(spark):
    t = spark.createDataFrame([(HASH, 1), (HASH, 1), ("-1", 2), ("-1", 3), ("one", 4), (None, 4)], "k string, n int")
    many = failing_rows(t, Check("unique", "t", "k"))
    assert "unhex" in many._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, many.collect())) == [("-1", 2), (HASH, 2)]
    assert sorted(map(tuple, failing_rows(t, Check("unique", "t", "n")).collect())) == [(1, 2), (4, 2)]
    related = Check("relationships", "t", "k", to_table="u", to_column="k")
    assert sorted(map(tuple, failing_rows(t, related, None, t.where("k = 'one'").select("k")).collect())) == [("-1", 2), (HASH, 2)]
    other = Check("relationships", "t", "n", to_table="u", to_column="k")
    assert sorted(map(tuple, failing_rows(t, other, None, spark.createDataFrame([("1",), ("2",)], "k string")).collect())) == [(3, 1), (4, 2)]


def test_the_forecast_reads_written_demand(spark):
    from starmart.plans.queries import REGISTRY

    files = REGISTRY["product_forecast"](spark, SMOKE).inputFiles()
    assert files and all("/demand-" in f for f in files)


def test_snapshot_rows_meet_their_deletes_as_bytes(spark):
    from starmart.sources.snapshots import Snapshot, SnapshotStore

    schema = "order_item_id string, v int, m int"
    rows = spark.createDataFrame([(HASH, 1, 200101), ("-1", 2, 200101), ("kept", 3, 200102), (HASH[::-1], 4, 200102)], schema)
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    folders = [store.write(rows, "lines", seq=1, month="m"),
               store.write(rows.where("v in (1, 2)").select("order_item_id", "m"), "lines", seq=2, kind="deletes", month="m"),
               store.write(rows.where("v = 1"), "lines", seq=2, month="m")]
    now = store.read(Snapshot(2, {"lines": tuple(folders)}), "lines", schema, "order_item_id", None, "m")
    assert now.columns == ["order_item_id", "v", "m"]
    assert sorted(map(tuple, now.collect())) == sorted([(HASH, 1, 200101), ("kept", 3, 200102), (HASH[::-1], 4, 200102)])
    assert "unhex" in now._jdf.queryExecution().optimizedPlan().toString()
