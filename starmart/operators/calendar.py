"""Calendar dimension: one row per day over the data's date span.

The bounds are a one-row aggregate over staging (partial aggregation, no
driver round trip) and the day spine is generated from it with
``explode(sequence(...))``.  Its size is bounded by the number of days in the
span (≈ 365 per year of data), never by the number of order lines, so it is a
safe broadcast side for the fact's calendar join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import CALENDAR_FALLBACK
from starmart.functions import date_key, day_name, iso_weekday, month_name

CALENDAR_COLUMNS = ("date_key", "week_of_year", "full_date", "year", "month", "day",
                    "quarter", "day_of_year", "day_name", "month_name", "is_weekend",
                    "is_weekday")


def calendar_bounds(lines: DataFrame | None, pad_days: int = 7,
                    ts_col: str = "invoice_date") -> DataFrame:
    """One row (start, end): ``[min(date) - pad, max(date) + pad)``.

    ``lines is None`` (no staging relation yet) gives the fixed fallback span;
    an empty relation makes the plan raise when it runs."""
    if lines is None:
        raise ValueError("use calendar_fallback(spark) when staging does not exist")
    b = lines.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    guard = F.when(F.col("lo").isNull(),
                   F.raise_error(F.lit("calendar bounds: the order-line relation is empty")))
    return b.select(
        F.coalesce(guard.cast("date"), F.date_sub("lo", pad_days)).alias("start"),
        F.coalesce(guard.cast("date"), F.date_add("hi", pad_days)).alias("end"),
    )


def calendar_fallback(spark: SparkSession) -> DataFrame:
    lo, hi = CALENDAR_FALLBACK
    return spark.createDataFrame([(lo, hi)], "start date, end date")


def _attributes(d: Column) -> list[Column]:
    dow = iso_weekday(d)
    return [
        date_key(d).alias("date_key"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.quarter(d).cast("int").alias("quarter"),
        F.dayofyear(d).cast("int").alias("day_of_year"),
        day_name(d).alias("day_name"),
        month_name(d).alias("month_name"),
        dow.isin(6, 7).alias("is_weekend"),
        (~dow.isin(6, 7)).alias("is_weekday"),
    ]


def calendar(bounds: DataFrame) -> DataFrame:
    """Expand (start, end) bounds (end exclusive) into calendar rows."""
    spine = bounds.filter(F.col("end") > F.col("start")).select(
        F.explode(F.sequence(F.col("start"), F.date_sub("end", 1),
                             F.expr("interval 1 day"))).alias("d"))
    return spine.select(*_attributes(F.col("d")))


def calendar_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return calendar(spark.createDataFrame([(start, end)], "start date, end date"))
