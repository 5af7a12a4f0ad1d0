"""Checks over what a batch changed, with stored outcomes and failing rows.

``check_new_lines`` runs the row-level staging checks over the line folders that
came since the last run (one scan for all checks) and stores, in one snapshot,
a row for each check (``check_results``) and one for each failing line and check
(``check_failures``).  ``current_failures`` leaves out lines that were replaced
since.  A compaction rewrites all lines, so the next run checks all of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit
from starmart.operators.checks import ROW_KINDS, Check
from starmart.plans import incremental
from starmart.plans.check_ledger import ledger
from starmart.sources.snapshots import SEQ, Snapshot, SnapshotStore

RESULTS = "run_ts timestamp_ntz, check_id string, severity string, rows_checked long, failures long"
FAILURES = "run_ts timestamp_ntz, check_id string, severity string, order_item_id string, written int"


def staging_checks() -> list[Check]:
    return [c for c in ledger() if c.table == "staging" and c.kind in ROW_KINDS]


def _fails(check: Check, as_of: dt.datetime) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "positive_value":
        return (c <= 0) | c.isNull()
    if check.kind == "not_in_future":
        return c > ts_lit(as_of)
    return ~F.expr(check.expression)


def check_new_lines(spark: SparkSession, root: str, as_of: dt.datetime, run_ts: dt.datetime) -> Snapshot:
    store = SnapshotStore(spark, root)
    now = store.load()
    done = now.properties.get("lines_checked", 0)
    new = Snapshot(now.number, {"lines": tuple(f for f in now.relations.get("lines", ()) if f.kind == "rows" and (f.seq or 0) > done)})
    checks = staging_checks()
    schema = incremental.SCHEMAS["lines"] + f", {SEQ} int"
    lines = store.read(new, "lines", schema)
    marks = F.filter(F.array(*[F.when(F.coalesce(_fails(c, as_of), F.lit(False)), F.struct(
        F.lit(c.check_id).alias("check_id"), F.lit(c.severity).alias("severity"))) for c in checks]), lambda x: x.isNotNull())
    failing = lines.select("order_item_id", F.col(SEQ).alias("written"), F.explode(marks).alias("c")).select(
        ts_lit(run_ts).alias("run_ts"), "c.check_id", "c.severity", "order_item_id", "written")
    failures = store.write(failing, "check_failures")
    stored = spark.read.schema(FAILURES).parquet(f"{root}/{failures.path}").groupBy("check_id").agg(F.count(F.lit(1)).alias("failures"))
    every = spark.createDataFrame([(c.check_id, c.severity) for c in checks], "check_id string, severity string")
    results = every.join(stored, "check_id", "left").select(
        ts_lit(run_ts).alias("run_ts"), "check_id", "severity", F.lit(lines.count()).cast("long").alias("rows_checked"),
        F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))
    return store.commit(now, {"check_failures": [*now.relations.get("check_failures", ()), failures],
                              "check_results": [*now.relations.get("check_results", ()), store.write(results, "check_results")]},
                        {"lines_checked": now.number})


def results(spark: SparkSession, root: str) -> DataFrame:
    store = SnapshotStore(spark, root)
    return store.read(store.load(), "check_results", RESULTS)


def current_failures(spark: SparkSession, root: str) -> DataFrame:
    """(check_id, severity, order_item_id) of failing lines that still stand, each once."""
    store = SnapshotStore(spark, root)
    now = store.load()
    found = store.read(now, "check_failures", FAILURES)
    gone = Snapshot(now.number, {"lines": tuple(f for f in now.relations.get("lines", ()) if f.kind == "deletes")})
    if "lines" in gone:
        deletes = store.deleted(gone, "lines", "order_item_id")
        found = found.join(deletes, (found["order_item_id"] == deletes["key"]) & (found["written"] < deletes["at"]), "left_anti")
    return found.select("check_id", "severity", "order_item_id").distinct()
