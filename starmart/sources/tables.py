"""Table sinks: versioned publish with a row gate, and the month-partitioned fact.

* ``publish`` writes a *new* directory, checks it, and only then points the
  catalog table at it (``ALTER TABLE ... SET LOCATION``).  Readers of the old
  version are never disturbed; a failed gate leaves the old version current.
* Fact folders are partitioned by month; a batch writes the months it touches
  into a folder of its own (``plans.build``), never over files that are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.keys import packed_key, unpacked_key
from starmart.session import PARQUET, scratch_path

MONTH = "date_month"
HEX_KEYS = ("order_item_id", "customer_key", "product_key")     # fixed: the columns that hold hex hashes


class RowGateError(RuntimeError):
    pass


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = ()) -> str:
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def publish(spark: SparkSession, df: DataFrame, name: str, min_rows: int = 0,
            sort_within: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a new version of table ``name`` and switch to it.

    Raises RowGateError (old version stays current) when fewer than
    ``min_rows`` rows were written."""
    path = write_version(df, scratch_path(spark, name), sort_within=sort_within)
    written = spark.read.parquet(path)
    n = written.count()
    if n < min_rows:
        raise RowGateError(f"{name}: {n} rows written, {min_rows} required; "
                           f"current version kept")
    if _table_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def read_declared(spark: SparkSession, path: str, declared) -> DataFrame:
    """Read a Parquet source and refuse it unless its columns and types are
    the declared ones (names order-insensitive)."""
    from starmart.operators.fact import assert_same_schema  # local: avoid an import cycle

    df = spark.read.parquet(path)
    assert_same_schema(declared, df)
    return df


def peek(spark: SparkSession, name: str, n: int = 3) -> DataFrame:
    return spark.table(name).limit(n)


# ---------------------------------------------------------------- partitioned fact
def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, (F.col("date_key") / 100).cast("int"))


def write_fact(spark: SparkSession, fact: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Write fact rows month-partitioned and clustered by (date_key, customer_key).

    ``rebalance`` on the month lets AQE cut each month into advisory-size
    pieces (a month holding a large share of the rows is split over many
    tasks, small months are merged), so file sizes stay even at any scale;
    each piece is sorted by (date_key, customer_key) for min/max pruning.
    Rows are dealt with their hex keys as bytes, or as ``fact`` has them if
    ``finish`` makes the rows to be written (month included) from them."""
    rows = with_month(fact)
    if finish is None:
        rows = rows.withColumns({c: packed_key(c) for c in HEX_KEYS if c in fact.columns})
    dealt = rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "date_key", "customer_key")
    df = finish(dealt) if finish else dealt.withColumns({c: unpacked_key(c) for c in HEX_KEYS if c in fact.columns})
    df.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .options(**PARQUET).partitionBy(MONTH).parquet(path)


def read_fact(spark: SparkSession, path: str, months: Sequence[int] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if months is not None:
        df = df.filter(F.col(MONTH).isin(list(months)))
    return df.drop(MONTH)


def batch_months(batch: DataFrame) -> list[int]:
    """Distinct months of a batch (bounded by the calendar months it spans)."""
    rows = with_month(batch).select(MONTH).distinct().collect()
    return sorted(r[0] for r in rows if r[0] is not None)


def compact_fact(spark: SparkSession, path: str, new_path: str) -> None:
    """Re-cluster the whole fact into a new location (weekly compaction)."""
    write_fact(spark, read_fact(spark, path), new_path)
