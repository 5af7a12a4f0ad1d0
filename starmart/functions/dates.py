"""Calendar column expressions (locale-free)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names, ISO order (Monday = 1) and calendar order.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December")


def ts_lit(value: dt.datetime | dt.date) -> Column:
    """Wall-clock timestamp literal (no zone), independent of the session and
    Python-process time zones."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_weekday(col: Column | str) -> Column:
    """ISO day of week: 1 = Monday .. 7 = Sunday (Spark's dayofweek is Sunday = 1)."""
    return (F.weekday(_c(col)) + 1).cast("int")


def day_name(col: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), iso_weekday(col))


def month_name(col: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(_c(col)))


def date_key(col: Column | str) -> Column:
    """yyyymmdd as INT."""
    d = _c(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_index(col: Column | str) -> Column:
    d = _c(col)
    return F.year(d) * 12 + F.month(d)


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (Jan-31 -> Feb-01 = 1)."""
    return (month_index(end) - month_index(start)).cast("int")


def month_start(col: Column | str) -> Column:
    """First instant of the month, as TIMESTAMP without zone."""
    return F.date_trunc("month", _c(col)).cast("timestamp_ntz")
