"""Sums and distinct counts by key, for which a line is dealt once.

A distinct count as an aggregate of its own deals every (key, item) pair, and a
key's lines seldom repeat one, so several counts deal every line several times
over, each time with its sums beside it.  Here lines are dealt once, by key and
as narrow as they are, and everything is summed where they are.

Heavy keys (``temporal_join.heavy_keys``) would fill a task: their lines are
summed in the tasks that read them before anything is dealt, and dealt by key
and item.  So are all lines if it is not known which keys are heavy.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND, ITEM = "__kind", "__item"
LINES_A_TASK = 1 << 18                  # lines that a task sums, about


def grouped(lines: DataFrame, keys: Sequence[str], items: Sequence[str], inner: Sequence[Column], outer: Sequence[Column],
            derived: dict[str, Column] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``lines`` by ``keys``: ``inner`` aggregates of each (key, ``KIND``, ``ITEM``), kind ``i`` holding every line under the
    value of ``items[i]``, then ``outer`` aggregates of these rows by key.  ``derived`` columns are worked out behind the shuffle.
    ``hot`` (with the key columns): the heavy keys, if ``lines`` are written, so that reading them twice costs no work."""
    def of(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(derived or {})
        each = F.array(*[F.struct(F.lit(i).alias(KIND), F.col(c).cast("string").alias(ITEM)) for i, c in enumerate(items)])
        rows = rows.select("*", F.explode(each).alias("__each")).select("*", "__each.*") if len(items) > 1 else rows.withColumns(
            {KIND: F.lit(0), ITEM: F.col(items[0])})
        return rows.groupBy(*keys, KIND, ITEM).agg(*inner).groupBy(*keys).agg(*outer)

    if hot is None:
        return of(lines)
    heavy = F.broadcast(hot.select(*keys))
    parts = max(math.ceil(lines.count() / LINES_A_TASK), int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if hot.isEmpty():
        return of(lines.repartition(parts, *keys))
    return of(lines.join(heavy, list(keys), "left_anti").repartition(parts, *keys)).unionByName(of(lines.join(heavy, list(keys), "left_semi")))
