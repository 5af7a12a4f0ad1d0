"""Source freshness: age of the newest load stamp against warn/error limits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit


def freshness(df: DataFrame, loaded_at: str, as_of: dt.datetime,
              warn_hours: int = 24, error_hours: int = 48,
              group_by: tuple[str, ...] = ()) -> DataFrame:
    """``max(loaded_at)`` per group (or overall) -> age and pass/warn/error.

    One partial aggregate; ``as_of`` is injected so results are reproducible."""
    agg_cols = [F.max(loaded_at).alias("max_loaded_at")]
    agg = df.groupBy(*group_by).agg(*agg_cols) if group_by else df.agg(*agg_cols)
    now = ts_lit(as_of)
    age_s = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    return agg.select(
        *group_by,
        "max_loaded_at",
        now.alias("as_of"),
        (age_s / F.lit(3600.0)).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age_s > error_hours * 3600, F.lit("error"))
        .when(age_s > warn_hours * 3600, F.lit("warn"))
        .otherwise(F.lit("pass")).alias("status"),
    )
