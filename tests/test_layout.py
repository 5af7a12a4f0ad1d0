"""Z-order against a plain sort."""

from pyspark.sql import functions as F

from starmart.operators.layout import layout_report, order_number, write_z_ordered, z_key
from starmart.plans.queries import LAYOUT_COLUMNS, REGISTRY

from .conftest import SMOKE


def test_z_order_narrows_every_column(spark):
    got = {(r.layout, r.column): r for r in REGISTRY["clustering_depth"](spark, SMOKE).collect()}
    assert all(got["z_order", c].files > 50 for c in LAYOUT_COLUMNS)
    for c in LAYOUT_COLUMNS[1:]:  # a sort by day leaves the other columns as they are: every file holds nearly all values
        assert got["by_day", c].mean_read > 50 and got["z_order", c].mean_read < 0.5 * got["by_day", c].mean_read


def test_report_counts_overlaps_and_rows_stay(spark, tmp_path):
    rows = [(i, chr(97 + i % 5), "x" if i % 3 else None) for i in range(400)] + [(7, "a", f"x{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    path = str(tmp_path / "z")
    write_z_ordered(df, ("a", "b"), path, 8)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 250  # the common row fills several files
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.min("a").alias("lo"), F.max("a").alias("hi")).collect()
    depth = [sum(x.lo <= y.hi and x.hi >= y.lo for x in files) for y in files]
    r = {x.column: x for x in layout_report(back, ("a", "b")).collect()}["a"]
    assert r.files == len(files) and r.max_depth == max(depth) and abs(r.mean_depth - sum(depth) / len(depth)) < 1e-9


def test_order_numbers_are_worked_out_once_a_row(spark, tmp_path):
    rows = [(i % 97, f"k{i * 7919 % 89:02d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b string")
    numbered = df.withColumns({f"__n{j}": order_number(df, c) for j, c in enumerate(df.columns)})
    keyed = numbered.select("a", "b", z_key(df, df.columns).alias("z"))
    assert keyed._jdf.queryExecution().optimizedPlan().toString().count("conv(") == 1
    # the key against its definition: bits of the numbers of quantiles below a value, in turn
    shares = [i / 64 for i in range(1, 64)]
    edges = [sorted(set(df.agg(F.percentile_approx(order_number(df, c), shares, 10_000)).first()[0])) for c in df.columns]
    for r in keyed.join(numbered.distinct(), ["a", "b"]).limit(300).collect():
        numbers = [sum(v > e for e in edges[j]) for j, v in enumerate((r["__n0"], r["__n1"]))]
        assert r.z == sum((numbers[j] >> k & 1) << (2 * k + j) for j in (0, 1) for k in range(6))
