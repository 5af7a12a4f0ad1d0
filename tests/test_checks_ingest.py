import datetime as dt
import os
import tempfile
import warnings

import pytest

from starmart.operators.checks import Check, run_checks
from starmart.plans.check_ledger import ledger
from starmart.sources import read_order_csv, validate_order_csv
from starmart.sources.freshness import freshness
from starmart.sources.tables import RowGateError, publish

AS_OF = dt.datetime(2020, 1, 10)


def test_ledger_has_148_checks():
    checks = ledger()
    assert len(checks) == 148
    assert len({c.check_id for c in checks}) == 148
    assert sum(c.kind == "relationships" for c in checks) == 6
    assert all(c.severity == "warn" for c in checks if c.kind == "relationships")


def test_each_check_kind_finds_its_failing_row(spark):
    child = spark.createDataFrame([
        (1, "a", 5.0, dt.datetime(2020, 1, 1), "p1", True),
        (1, None, 0.0, dt.datetime(2021, 1, 1), "zz", None),
        (2, "b", None, dt.datetime(2020, 1, 2), None, False),
    ], "id int, name string, price double, ts timestamp_ntz, parent string, flag boolean")
    parent = spark.createDataFrame([("p1",)], "key string")
    checks = [
        Check("not_null", "c", "name"), Check("unique", "c", "id"),
        Check("unique", "c", "id", where="name IS NOT NULL"),
        Check("accepted_values", "c", "flag", values=("true",)),
        Check("relationships", "c", "parent", "warn", to_table="p", to_column="key"),
        Check("positive_value", "c", "price"), Check("not_in_future", "c", "ts"),
        Check("expression_is_true", "c", "price", expression="price > 1"),
    ]
    report = {r.check_id: r for r in run_checks({"c": child, "p": parent}, checks, AS_OF).collect()}
    got = {cid: (r.failures, r.status) for cid, r in report.items()}
    assert got["not_null__c__name"] == (1, "error")
    assert got["unique__c__id"] == (1, "error")                 # one duplicated value
    assert got["unique__c__id__current"] == (0, "pass")
    assert got["accepted_values__c__flag"] == (1, "error")     # NULL passes
    assert got["relationships__c__parent__p"] == (1, "warn")   # NULL child passes
    assert got["positive_value__c__price"] == (2, "error")     # 0 and NULL fail
    assert got["not_in_future__c__ts"] == (1, "error")
    assert got["expression_is_true__c__price"] == (1, "error")  # NULL passes


def _csv(rows, header="Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"):
    d = tempfile.mkdtemp(prefix="starmart-csv-")
    p = os.path.join(d, "in.csv")
    with open(p, "w", encoding="utf-8") as f:
        if header is not None:
            f.write(header + "\n")
        for r in rows:
            f.write(r + "\n")
    return p


def _good(n):
    return [f"INV{i:06d},SKU{i:05d},Item {i},{i + 1},2025-01-15 12:00:00,{i + 1}.99,{10000 + i},UK"
            for i in range(n)]


def test_validate_and_read_csv(spark):
    p = _csv(_good(5))
    assert validate_order_csv(spark, p).rows == 5
    raw = read_order_csv(spark, p, dt.datetime(2025, 1, 16))
    assert raw.count() == 5 and raw.columns[-1] == "_ingested_at"
    assert raw.filter("customer_id = '10000'").count() == 1
    with pytest.raises(FileNotFoundError):
        validate_order_csv(spark, p + ".missing")
    empty = _csv([], header=None)
    with pytest.raises(ValueError):
        validate_order_csv(spark, empty)
    ragged = _csv(_good(3) + ["just-one-column"])
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        res = validate_order_csv(spark, ragged)
    assert res.rows == 4 and res.malformed == 1 and w


def test_csv_quotes_newlines_and_several_files(spark, tmp_path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"
    quoted = 'A1,S1,"5"" CAKE STAND, ""RETRO""",1,2025-01-15 12:00:00,1.50,7,UK'
    broken = 'A2,S2,"two\nlines",2,2025-01-15 12:00:00,2.50,"",UK'
    (tmp_path / "a.csv").write_text("\ufeff" + header + "\n" + quoted + "\n\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(header + "\n" + broken + "\n", encoding="utf-8")
    res = validate_order_csv(spark, str(tmp_path))
    assert (res.rows, res.malformed) == (2, 0)
    got = {r.invoice_no: r for r in read_order_csv(spark, str(tmp_path), AS_OF).collect()}
    assert got["A1"].description == '5" CAKE STAND, "RETRO"' and got["A1"].quantity == "1"
    assert got["A2"].description == "two\nlines" and got["A2"].customer_id == ""
    flat = read_order_csv(spark, str(tmp_path / "a.csv"), AS_OF, multi_line=False).collect()
    assert [r.description for r in flat] == ['5" CAKE STAND, "RETRO"']
    (tmp_path / "c.csv").write_text(header.replace("Price", "Cost") + "\n" + quoted + "\n")
    with pytest.raises(ValueError):
        validate_order_csv(spark, str(tmp_path))


def test_csv_write_and_read_back(spark, tmp_path):
    from starmart.sources.csv_orders import write_order_csv

    raw = spark.createDataFrame(
        [("i", "s", t, "1", "2025-01-15", "1.0", c, None)
         for t, c in (('a "b", c', ""), (" padded ", None), ("x\ny", "7"), (None, "back\\slash"))],
        "invoice_no string, stock_code string, description string, quantity string, "
        "invoice_date string, unit_price string, customer_id string, country string")
    path = str(tmp_path / "out")
    write_order_csv(raw, path)
    back = read_order_csv(spark, path, AS_OF).drop("_ingested_at")
    assert raw.exceptAll(back).count() == 0 and back.count() == 4


def test_publish_gate_keeps_old_version(spark):
    good = read_order_csv(spark, _csv(_good(20)), dt.datetime(2025, 1, 16))
    publish(spark, good, "raw_orders_gate", min_rows=5)
    assert spark.table("raw_orders_gate").count() == 20
    small = read_order_csv(spark, _csv(_good(3)), dt.datetime(2025, 1, 17))
    with pytest.raises(RowGateError):
        publish(spark, small, "raw_orders_gate", min_rows=100)
    assert spark.table("raw_orders_gate").count() == 20


def test_freshness_levels(spark):
    df = spark.createDataFrame([("a", dt.datetime(2020, 1, 9, 12)), ("b", dt.datetime(2020, 1, 8, 12)),
                                ("c", dt.datetime(2020, 1, 7, 0))], "src string, ts timestamp_ntz")
    got = {r.src: r.status for r in freshness(df, "ts", AS_OF, group_by=("src",)).collect()}
    assert got == {"a": "pass", "b": "warn", "c": "error"}


def test_csv_to_staging_end_to_end(spark):
    from starmart.operators.staging import clean_order_lines

    dirty = [
        " ,SKU1,x,1,2025-01-15 12:00:00,1.00,1,UK",          # space-only invoice: kept as ''
        "INVX,SKU1,x,1,not a date,1.00,1,UK",                 # unparseable date: kept, NULL
        "INVY,SKU1,x,1,2025-01-15 12:00:00,0,1,UK",           # zero price: dropped
        "INVZ,SKU1,x,abc,2025-01-15 12:00:00,2.50,,UK",       # bad quantity, blank customer
        '"INVQ","SKU2","comma, inside",2,2025-01-15 12:00:00,3.00,7,UK',
    ]
    raw = read_order_csv(spark, _csv(_good(20) + dirty), dt.datetime(2025, 1, 16))
    stg = {r.invoice_no: r for r in clean_order_lines(raw.drop("_ingested_at")).collect()}
    assert len(stg) == 24 and "INVY" not in stg
    assert stg[""].stock_code == "SKU1" and stg["INVX"].invoice_date is None
    assert stg["INVZ"].quantity is None and stg["INVZ"].customer_id == "__missing"
    assert stg["INVQ"].description == "comma, inside"
