import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    day_name, iso_weekday, month_diff, month_name, safe_decimal, safe_int, safe_timestamp,
    surrogate_key,
)


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_safe_int_matches_numeric_try_cast(spark):
    vals = ["5", "5.5", "5.0", "1e3", "2.4999999", "-2.5", "abc", "", " 7 ", "99999999999", None]
    assert _one_col(spark, vals, safe_int) == [5, 6, 5, 1000, 2, -3, None, None, 7, None, None]


def test_safe_timestamp_requires_full_date(spark):
    vals = ["2010-12-01 08:26:00", "2010", "2010-01", "12/1/2010 8:26", "2010-1-5 8:26",
            "2010-01-05", "2010-01-05 ", "garbage", None]
    got = _one_col(spark, vals, safe_timestamp)
    assert got[0] == dt.datetime(2010, 12, 1, 8, 26)
    assert got[1] is None and got[2] is None and got[3] is None
    assert got[4] == dt.datetime(2010, 1, 5, 8, 26)
    assert got[5] == dt.datetime(2010, 1, 5)
    assert got[6] is None and got[7] is None and got[8] is None


def test_safe_decimal_rounds_half_up_and_overflows_to_null(spark):
    from decimal import Decimal

    vals = ["1.005", "0", "-1", "abc", "123456789012.5", "2.5"]
    got = _one_col(spark, vals, lambda c: safe_decimal(c, 10, 2))
    assert got == [Decimal("1.01"), Decimal("0.00"), Decimal("-1.00"), None, None,
                   Decimal("2.50")]


def test_surrogate_key_is_md5_of_dash_joined_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    got = df.select(surrogate_key("x", "y", "z")).collect()[0][0]
    assert got == hashlib.md5(b"a--3").hexdigest()


def test_calendar_names_and_iso_weekday(spark):
    df = spark.createDataFrame([(dt.date(2010, 1, 3),), (dt.date(2024, 2, 29),)], "d date")
    rows = df.select(iso_weekday("d"), day_name("d"), month_name("d")).collect()
    assert tuple(rows[0]) == (7, "Sunday", "January")
    assert tuple(rows[1]) == (4, "Thursday", "February")


@pytest.mark.parametrize("a,b,expected", [
    (dt.date(2020, 1, 31), dt.date(2020, 2, 1), 1),
    (dt.date(2020, 1, 1), dt.date(2020, 1, 31), 0),
    (dt.date(2019, 12, 15), dt.date(2020, 4, 1), 4),
])
def test_month_diff_counts_boundaries(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a date, b date")
    assert df.select(month_diff("a", "b")).collect()[0][0] == expected
