"""Top-1 per group.

``row_number() = 1`` over a window is what Catalyst turns into a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so each
task forwards at most one row per key it has seen: a hot key costs one sort
run, not a group collected in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def keep_first(df: DataFrame, keys: Sequence[str | Column],
               order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` must spell null placement explicitly (``asc_nulls_last`` ...)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)
