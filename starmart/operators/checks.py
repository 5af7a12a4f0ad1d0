"""Declarative data-quality checks over DataFrames.

Each check yields a failure count; zero is a pass, otherwise the outcome is
the check's severity (``error`` or ``warn``).  Failure counting follows the
usual column-test conventions: rows for not_null / positive_value /
not_in_future / expression_is_true / relationships, duplicated *values* for
unique, unaccepted distinct *values* for accepted_values; NULLs pass unique,
accepted_values, relationships and expression_is_true.

Execution: all row-level checks of one table are folded into a single
aggregate (one scan, ``count_if`` per check).  unique / accepted_values /
relationships aggregate their column first (partial aggregation, so only
distinct keys are shuffled) before counting.  Every check result is a one-row
DataFrame; the report is their union, run as one Spark job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from starmart.functions.dates import ts_lit
from starmart.functions.keys import packed_key, unpacked_key

ROW_KINDS = ("not_null", "positive_value", "not_in_future", "expression_is_true")
REPORT_COLUMNS = ("check_id", "kind", "table_name", "column_name", "severity", "failures",
                  "status")


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    severity: str = "error"
    where: str | None = None                 # SQL predicate applied first
    values: tuple[str, ...] = ()             # accepted_values
    to_table: str | None = None              # relationships
    to_column: str | None = None
    expression: str | None = None            # expression_is_true

    @property
    def check_id(self) -> str:
        suffix = f"__{self.to_table}" if self.kind == "relationships" else ""
        scope = "__current" if self.where else ""
        return f"{self.kind}__{self.table}__{self.column}{suffix}{scope}"


# ------------------------------------------------------------------ predicates
def _dealt_as(df: DataFrame, column: str):
    """How keys of a column are dealt, and what makes them of it again: texts, most of them hashes, as bytes."""
    return (packed_key, unpacked_key) if df.schema[column].dataType == StringType() else (F.col, F.col)


def failing_rows(df: DataFrame, check: Check, as_of: dt.datetime | None = None,
                 parent: DataFrame | None = None) -> DataFrame:
    """The failing rows (or values) of one check, as a DataFrame."""
    if check.where:
        df = df.filter(F.expr(check.where))
    c = F.col(check.column)
    k = check.kind
    if k == "not_null":
        return df.filter(c.isNull())
    if k == "positive_value":
        return df.filter((c <= 0) | c.isNull())
    if k == "not_in_future":
        return df.filter(c > ts_lit(as_of))
    if k == "expression_is_true":
        return df.filter(~F.expr(check.expression))
    if k == "unique":
        pack, unpack = _dealt_as(df, check.column)
        many = df.filter(c.isNotNull()).groupBy(pack(check.column).alias("__key")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        return many.select(unpack("__key").alias(check.column), "n")
    if k == "accepted_values":
        return (df.filter(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                .filter(~c.cast("string").isin(list(check.values))))
    if k == "relationships":
        if parent is None:
            raise ValueError(f"{check.check_id}: parent table missing")
        pack, unpack = _dealt_as(df, check.column)
        if _dealt_as(parent, check.to_column)[0] != pack:   # a text against another type: compared as they are
            pack = unpack = F.col
        keys = parent.select(pack(check.to_column).alias("__parent")).distinct()
        child = df.filter(c.isNotNull()).groupBy(pack(check.column).alias("__key")).agg(F.count(F.lit(1)).alias("n"))
        return child.join(keys, F.col("__key") == F.col("__parent"), "left_anti").select(unpack("__key").alias(check.column), "n")
    raise ValueError(f"unknown check kind {k}")


def _count_expr(check: Check, as_of: dt.datetime | None):
    c = F.col(check.column)
    k = check.kind
    if k == "not_null":
        pred = c.isNull()
    elif k == "positive_value":
        pred = (c <= 0) | c.isNull()
    elif k == "not_in_future":
        pred = c > ts_lit(as_of)
    else:  # expression_is_true
        pred = ~F.expr(check.expression)
    if check.where:
        pred = F.expr(check.where) & pred
    return F.count_if(F.coalesce(pred, F.lit(False)))


def _report_row(df_one: DataFrame, check: Check, failures_col: str = "failures") -> DataFrame:
    n = F.col(failures_col).cast("bigint")
    return df_one.select(
        F.lit(check.check_id).alias("check_id"), F.lit(check.kind).alias("kind"),
        F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"), n.alias("failures"),
        F.when(n > 0, F.lit(check.severity)).otherwise(F.lit("pass")).alias("status"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check],
               as_of: dt.datetime | None = None) -> DataFrame:
    """Failure count and outcome per check, as one DataFrame."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for ch in checks:
        by_table.setdefault(ch.table, []).append(ch)
    for table, chs in by_table.items():
        df = tables[table]
        row_checks = [c for c in chs if c.kind in ROW_KINDS]
        if row_checks:
            agg = df.agg(*[_count_expr(c, as_of).alias(f"c{i}")
                           for i, c in enumerate(row_checks)])
            # one scan for all row-level checks; unpivot into report rows
            rows = [F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.kind).alias("kind"),
                             F.lit(c.table).alias("table_name"),
                             F.lit(c.column).alias("column_name"),
                             F.lit(c.severity).alias("severity"),
                             F.col(f"c{i}").cast("bigint").alias("failures"))
                    for i, c in enumerate(row_checks)]
            stacked = agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
            parts.append(stacked.withColumn(
                "status", F.when(F.col("failures") > 0, F.col("severity"))
                .otherwise(F.lit("pass"))))
        for c in chs:
            if c.kind in ROW_KINDS:
                continue
            parent = tables.get(c.to_table) if c.to_table else None
            bad = failing_rows(df, c, as_of, parent)
            n = (F.sum("n") if c.kind == "relationships" else F.count(F.lit(1)))
            parts.append(_report_row(bad.agg(F.coalesce(n, F.lit(0)).alias("failures")), c))
    return reduce(lambda a, b: a.unionByName(b), parts)


def summarize(report: DataFrame) -> DataFrame:
    """Counts of pass / warn / error outcomes."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


# ------------------------------------------------------------------ table-level checks
def row_parity(spark: SparkSession, a: DataFrame, b: DataFrame,
               tolerance: float = 0.001) -> DataFrame:
    """One row when |rows(a) - rows(b)| exceeds ``tolerance`` x rows(b) (failure);
    empty on success.  Integer arithmetic with the tolerance rounded, so the
    bound does not depend on the engine's decimal-to-integer rule."""
    j = a.agg(F.count(F.lit(1)).alias("fact_rows")).withColumn(
        "staging_rows", b.agg(F.count(F.lit(1))).scalar())
    allowed = F.round(F.col("staging_rows").cast("decimal(38,0)") * F.lit(tolerance), 0) \
        .cast("bigint")
    return j.select(
        F.col("fact_rows").cast("bigint").alias("fact_rows"),
        F.col("staging_rows").cast("bigint").alias("staging_rows"),
        allowed.alias("allowed_difference"),
        (F.abs(F.col("fact_rows") - F.col("staging_rows")) > allowed).alias("failed"),
    )


def high_value_negative(customers: DataFrame) -> DataFrame:
    """Failing rows: high_value customers whose gross revenue is <= 0."""
    return customers.filter((F.col("customer_segment") == "high_value")
                            & (F.col("gross_revenue") <= 0)) \
        .select("customer_id", "customer_segment", "gross_revenue")


def grain_duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations of ``cols`` that occur more than once (grain check)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def history_depth(history: DataFrame, key: str) -> DataFrame:
    """Versions per key summary: keys, rows, rows per key, keys with >1 version,
    max versions of one key."""
    per_key = history.groupBy(key).agg(F.count(F.lit(1)).alias("v"))
    return per_key.agg(
        F.count(F.lit(1)).cast("bigint").alias("keys"),
        F.sum("v").cast("bigint").alias("rows"),
        F.round(F.sum("v") / F.count(F.lit(1)), 4).alias("rows_per_key"),
        F.count_if(F.col("v") > 1).cast("bigint").alias("keys_with_history"),
        F.max("v").cast("bigint").alias("max_versions"),
    )


# ------------------------------------------------------------------ time-series checks
def daily_row_sigma(df: DataFrame, ts_col: str, as_of: dt.datetime, trend_days: int = 28,
                    test_days: int = 7, sigma: float = 3.0) -> DataFrame:
    """Daily row count vs. the trailing ``trend_days`` rows (mean, sample
    stddev, excluding the day itself), for the days in the test window.
    The ordered window runs over one row per day (bounded by the calendar)."""
    from pyspark.sql import Window

    daily = df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("day").rowsBetween(-trend_days, -1)
    stats = daily.select("day", "n", F.avg("n").over(w).alias("avg"),
                         F.stddev_samp("n").over(w).alias("std"))
    z = (F.col("n") - F.col("avg")) / F.nullif(F.col("std"), F.lit(0.0))
    return stats.filter((F.col("day") >= F.date_sub(F.lit(as_of.date()), test_days))
                        & F.col("std").isNotNull()).select(
        "day", F.col("n").cast("bigint").alias("n"),
        F.round("avg", 4).alias("rolling_avg"), F.round("std", 4).alias("rolling_std"),
        F.round(z, 4).alias("z_score"),
        F.coalesce(F.abs(z) > sigma, F.lit(False)).alias("is_anomaly"))


def moving_stdev_check(df: DataFrame, date_col: str, value_col: str, as_of: dt.datetime,
                       group_by: tuple[str, ...] = (), lookback: int = 1, trend: int = 28,
                       test_periods: int = 14, sigma: float = 3.0,
                       take_logs: bool = False) -> DataFrame:
    """Within-n-moving-stdevs test on a daily metric: per group, the change vs.
    ``lookback`` days earlier is scored against the mean / stddev of the
    previous ``trend`` changes; rows of the last ``test_periods`` days before
    ``as_of`` are reported with their sigma and outcome.  Windows are
    partitioned by the group columns."""
    from pyspark.sql import Window

    per_day = df.groupBy(F.to_date(date_col).alias("metric_period"), *group_by).agg(
        F.sum(F.col(value_col).cast("double")).alias("agg_metric_value"))
    v = F.col("agg_metric_value")
    metric = F.ln(F.nullif(v, F.lit(0.0))) if take_logs else v
    w = Window.partitionBy(*group_by).orderBy("metric_period") if group_by \
        else Window.orderBy("metric_period")
    with_diff = per_day.withColumn("metric_value", metric).withColumn(
        "metric_test_value", F.col("metric_value") - F.lag("metric_value", lookback).over(w))
    trail = w.rowsBetween(-trend, -1)
    stats = with_diff.select(
        "*", F.avg("metric_test_value").over(trail).alias("avg_"),
        F.stddev_samp("metric_test_value").over(trail).alias("std_"))
    score = (F.col("metric_test_value") - F.col("avg_")) / F.nullif(F.col("std_"), F.lit(0.0))
    today = F.lit(as_of.date())
    return stats.filter((F.col("metric_period") >= F.date_sub(today, test_periods))
                        & (F.col("metric_period") < today)).select(
        "metric_period", *group_by,
        F.round("agg_metric_value", 4).alias("agg_metric_value"),
        F.round("metric_test_value", 4).alias("metric_test_value"),
        F.round("avg_", 4).alias("metric_test_rolling_average"),
        F.round("std_", 4).alias("metric_test_rolling_stddev"),
        F.round(score, 4).alias("metric_test_sigma"),
        F.coalesce(F.abs(score) > sigma, F.lit(False)).alias("is_anomaly"))
