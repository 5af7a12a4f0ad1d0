"""Clustering files by several columns (Z-order) and measuring it.

Each column's values become range numbers by approximate quantiles (so every
range holds about as many rows, whatever the values' spread); the bits of the
numbers are interleaved into one key, and files are ranges of it.  A filter on
any of the columns then meets few files.  Rows of equal key are told apart by a
hash, so one very common value still fills several files.

The measure: a file's depth in a column is how many files (itself included)
overlap its value range; a filter on a value reads as many files as lie over it.
Only one row per file is ordered or held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType

BITS = 6


def order_number(df: DataFrame, name: str) -> Column:
    """A double that orders as the column does (text: by its first six bytes; null first)."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, NumericType):
        number = c.cast("double")
    elif isinstance(kind, DateType):
        number = F.unix_date(c).cast("double")
    elif isinstance(kind, StringType):
        number = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    else:  # timestamps
        number = F.unix_micros(c.cast("timestamp")).cast("double")
    return F.coalesce(number, F.lit(float("-inf")))


def _spread(number: int, place: int, columns: int, bits: int) -> int:
    """The bits of a column's range number at their places in the key."""
    return sum((number >> k & 1) << (k * columns + place) for k in range(bits))


def _by_range(value: Column, edges: Sequence[float], codes: Sequence[int]) -> Column:
    """``codes[n]`` of the number n of ``edges`` (ascending) below the value, by halving: a value meets the logarithm of their number."""
    if not edges:
        return F.lit(codes[0]).cast("long")
    m = len(edges) // 2
    return F.when(value > edges[m], _by_range(value, edges[m + 1:], codes[m + 1:])).otherwise(_by_range(value, edges[:m], codes[:m + 1]))


def z_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Interleaved range numbers of the columns, from their order numbers in columns ``__n0``, ``__n1`` and so on; reads one row of quantiles."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    bounds = df.agg(*[F.percentile_approx(order_number(df, c), shares, 10_000).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    key = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        edges = sorted(set(bounds[j] or ()))
        codes = [_spread(n, j, len(columns), bits) for n in range(len(edges) + 1)]
        key = key.bitwiseOR(_by_range(F.col(f"__n{j}"), edges, codes))
    return key


def write_z_ordered(df: DataFrame, columns: Sequence[str], path: str, files: int) -> None:
    # each order number is worked out once a row, however many ranges it is compared with
    numbered = df.withColumns({f"__n{j}": order_number(df, c) for j, c in enumerate(columns)})
    keyed = numbered.select(*[F.col(f"`{c}`") for c in df.columns], z_key(df, columns).alias("__z"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__h"))
    keyed.repartitionByRange(files, "__z", "__h").sortWithinPartitions("__z", *[f"`{c}`" for c in columns]).drop("__z", "__h").write.parquet(path)


def layout_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, files, mean_depth, max_depth, mean_read) of a Parquet relation read from its files.

    ``mean_read``: files that a filter on one value of the column reads, over the middle value of every file.
    """
    numbers = df.select(F.col("_metadata.file_path").alias("file"), *[order_number(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    files = numbers.groupBy("file").agg(*[F.struct(F.min(f"v{i}").alias("lo"), F.max(f"v{i}").alias("hi"), F.percentile_approx(f"v{i}", 0.5).alias("mid"))
                                          .alias(f"s{i}") for i in range(len(columns))])
    each = files.select("file", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), f"s{i}.*") for i, c in enumerate(columns)])).alias("r")).select(
        "file", "r.*")

    def point(kind: int, value: str, what: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(value).alias("v"), F.lit(what).alias("what"))

    # along a column's values: ranges that have started (0, before the question 1) and ended (2, after it)
    points = each.select("column", "file", F.explode(F.array(
        point(0, "lo", ""), point(2, "hi", ""), point(1, "lo", "lo"), point(1, "hi", "hi"), point(1, "mid", "mid"))).alias("p")).select("column", "file", "p.*")
    along = Window.partitionBy("column").orderBy("v", "kind").rowsBetween(Window.unboundedPreceding, 0)   # five rows a file
    asked = points.select("column", "file", "what", F.count_if(F.col("kind") == 0).over(along).alias("started"),
                          F.count_if(F.col("kind") == 2).over(along).alias("ended")).where("what <> ''")

    def at(what: str, count: str):
        return F.max(F.when(F.col("what") == what, F.col(count)))

    per_file = asked.groupBy("column", "file").agg((at("hi", "started") - at("lo", "ended")).alias("depth"),
                                                   (at("mid", "started") - at("mid", "ended")).alias("read"))
    return per_file.groupBy("column").agg(F.count(F.lit(1)).alias("files"), F.avg("depth").alias("mean_depth"), F.max("depth").alias("max_depth"),
                                          F.avg("read").alias("mean_read"))
