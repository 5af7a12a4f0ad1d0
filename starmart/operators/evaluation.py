"""Evaluation of scored rows with plain aggregations: rank-sum AUC and a confusion table.

AUC is the share of (positive, negative) pairs that the score puts in order, a
tie counting half.  Equal scores become one row of counts first; a running sum
over the ordered scores then gives, for each, the negatives below it.  It runs
in two levels (sums of score ranges, then inside a range), so no task orders
all scores.  Counts and the numerator are exact integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import PARQUET, scratch_path

_WIDE = "decimal(38,0)"


def rank_auc(df: DataFrame, score: str, label: str, by: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """(by..., n_pos, n_neg, auc) of 0 / 1 labels; auc is NULL without both classes; rows without score or label do not count."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(*by, F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    path = scratch_path(spark, "auc-counts")
    counts.repartitionByRange(n, *by, "s").withColumn("range", F.spark_partition_id()).write.options(**PARQUET).parquet(path)
    counts = spark.read.parquet(path)
    key = [*by, "range"]
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)   # one row a range
    sums = counts.groupBy(*key).agg(F.sum("neg").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy(*key).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key]
    c = counts.withColumn("upto", F.coalesce(F.sum("neg").over(inside), F.lit(0))).alias("c")
    c = c.join(sums.alias("r"), same).select(*[f"c.{k}" for k in by], "pos", "neg", (F.col("base") + F.col("upto")).alias("below"))
    twice = F.sum(F.col("pos").cast(_WIDE) * (2 * F.col("below") + F.col("neg")).cast("decimal(20,0)"))
    out = c.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), twice.cast("double").alias("twice"))
    pairs = F.lit(2.0) * F.col("n_pos") * F.col("n_neg")
    return out.select(*by, "n_pos", "n_neg", F.try_divide("twice", pairs).alias("auc"))


def confusion(df: DataFrame, score: str, label: str, threshold: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., tp, fp, fn, tn, precision, recall, f1) where a score of ``threshold`` or more says 1."""
    says, is_one = F.col(score) >= threshold, F.col(label) == 1
    counted = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).groupBy(*by).agg(
        F.count_if(says & is_one).alias("tp"), F.count_if(says & ~is_one).alias("fp"),
        F.count_if(~says & is_one).alias("fn"), F.count_if(~says & ~is_one).alias("tn"))
    tp = F.col("tp").cast("double")
    return counted.select("*", F.try_divide(tp, F.col("tp") + F.col("fp")).alias("precision"),
                          F.try_divide(tp, F.col("tp") + F.col("fn")).alias("recall"),
                          F.try_divide(2 * tp, 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
