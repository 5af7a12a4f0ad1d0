"""Raw order lines derived from the TPC-H-like driver tables.

The pipeline's natural input is a CSV of untyped order lines.  For tests and
the bench the same shape is derived from ``lineitem ⋈ orders ⋈ customer ⋈
nation ⋈ part``, rendered *as text* so staging really performs its safe casts.

Scale notes: every join is an equi join the optimizer plans by size; orders
(a quarter of the lines) are joined to customers before lines are to orders.  The
nation table has a fixed size of 25 rows and is broadcast explicitly; the
other dimensions are left to the size-checked auto-broadcast / AQE, so at
large scale they become shuffle joins instead of oversized broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = ("invoice_no", "stock_code", "description", "quantity",
               "invoice_date", "unit_price", "customer_id", "country")

# Fixed value of the test-data mapping: every 7th customer is written blank.
BLANK_CUSTOMER_MODULUS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped raw order lines (all columns STRING), one per lineitem row."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name")

    # orders get their customers before lines get their orders: a line is dealt by part and by order only
    placed = (
        od.join(cu.join(F.broadcast(na), cu.c_nationkey == na.n_nationkey), od.o_custkey == cu.c_custkey)
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    # lines are dealt with whole numbers instead of doubles and a text; they divide after that
    li = li.select("l_orderkey", "l_partkey", F.expr("cast(l_quantity as bigint)").alias("units"), (F.col("l_returnflag") == "R").alias("back"),
                   F.expr("cast(round(l_extendedprice * 100) as bigint)").alias("cents"))
    joined = li.join(pa, li.l_partkey == pa.p_partkey).join(placed, li.l_orderkey == placed.o_orderkey)
    signed_qty = F.when(F.col("back"), -F.col("units")).otherwise(F.col("units"))
    # integer cents divided by integer quantity: exact and engine-independent
    unit_price = (F.expr("cents div units") / F.lit(100.0)).cast("decimal(10,2)")
    customer = F.when(F.col("o_custkey") % BLANK_CUSTOMER_MODULUS == 0, F.lit("")) \
        .otherwise(F.col("o_custkey").cast("string"))
    return joined.select(
        F.col("l_orderkey").cast("string").alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        signed_qty.cast("int").cast("string").alias("quantity"),
        F.col("o_orderdate").cast("string").alias("invoice_date"),
        unit_price.cast("string").alias("unit_price"),
        customer.alias("customer_id"),
        F.col("n_name").alias("country"),
    )


def dirty_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw order lines, with faults put into rows chosen by their numbers:
    unparseable and missing dates, future dates, blank codes, zero, missing and
    text prices, zero, fractional and text quantities, missing descriptions and
    countries, padded text, customers who only send goods back, and lines that
    arrive twice with another description."""
    raw = raw_order_lines(spark, sf_dir)
    fault = F.pmod(F.col("invoice_no").cast("bigint") * 7 + F.col("stock_code").cast("bigint") * 3,
                   F.lit(97))
    only_returns = F.pmod(F.col("customer_id").try_cast("bigint"), F.lit(11)) == 0
    rows = raw.select(*RAW_COLUMNS, fault.alias("f"), only_returns.alias("back"))
    quantity = (F.when(F.col("back"), F.concat(F.lit("-"), F.ltrim("quantity", F.lit("-"))))
                .otherwise(F.col("quantity")))
    return rows.select(
        F.when(F.col("f") == 1, "").otherwise(F.col("invoice_no")).alias("invoice_no"),
        F.when(F.col("f") == 2, F.lit(None)).otherwise(F.col("stock_code")).alias("stock_code"),
        F.explode(F.when(F.col("f") == 3, F.array(F.lit(None).cast("string")))
                  .when(F.col("f").between(4, 6), F.array(
                      F.col("description"), F.concat(F.lit("  "), "description", F.lit(" (spare) "))))
                  .otherwise(F.array("description"))).alias("description"),
        F.when(F.col("f") == 7, "0").when(F.col("f") == 8, "2.5")
        .when(F.col("f") == 9, "many").otherwise(quantity).alias("quantity"),
        F.when(F.col("f") == 10, F.concat(F.lit("x"), "invoice_date"))
        .when(F.col("f") == 11, F.lit(None)).when(F.col("f") == 12, "2003-02-03 04:05:06")
        .otherwise(F.col("invoice_date")).alias("invoice_date"),
        F.when(F.col("f") == 13, "0").when(F.col("f") == 14, "free")
        .when(F.col("f") == 15, F.lit(None)).when(F.col("f") == 16, "-1.00")
        .otherwise(F.col("unit_price")).alias("unit_price"),
        F.when(F.col("f") == 17, F.lit(None)).when(F.col("f") == 18, "  ")
        .otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(F.col("f") == 19, F.lit(None)).when(F.col("f") == 20, F.concat(F.lit(" "), "country"))
        .otherwise(F.col("country")).alias("country"),
    )


def arrival_delay() -> Column:
    """Days by which an order line arrives late: 0, 3, 4 or 30, by its invoice."""
    return F.element_at(F.array(*[F.lit(d) for d in (0, 3, 4, 30)]),
                        (F.pmod(F.col("invoice_no").cast("bigint"), F.lit(4)) + 1).cast("int"))
