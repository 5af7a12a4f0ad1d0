"""Point-in-time (as-of) join of facts to type-2 history.

Spark has no native as-of join, and an equi join on the key with the validity
range as a residual compares each fact with every version of its key.  Facts
and versions are merged instead: both are laid in one relation, dealt by key,
sorted by time (a version before a fact of the same instant), and each fact
takes the last version that started (a running ``last`` that ignores nulls).
The ranges of a key are disjoint, so that version is the only candidate; it
matches if it is still valid.  One shuffle and one sort of facts and versions,
nothing that grows with the number of versions of a key, and no fan-out.

Skew: one natural key (e.g. the blank-customer sentinel) may own a large
share of the fact rows.  Rows of keys known to be heavy get a salt, as many
values as the key's share of the rows fills shuffle partitions; the versions
of those keys are repeated once per salt value.  The salts of all heavy keys
add up to at most twice the number of partitions (see ``heavy_keys``),
whatever the size of the data.  Facts without a key match nothing and are
dealt by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.config import FIRST_VERSION_FROM, OPEN_VERSION_TO
from starmart.functions.dates import ts_lit
from starmart.operators.scd2 import VALID_FROM, VALID_TO

_FROM = "__valid_from"
_TO = "__valid_to"
_SALT = "__salt"
_ROW, _VERSION, _KEY, _AT = "__row", "__version", "__key", "__at"
NULL_KEY_SALTS = 1 << 16
SALTS = "salts"
BUCKETS_A_PART = 16                     # buckets of keys that heavy_keys counts rows by, for each part


def version_ranges(history: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """(key, payload..., from, to) with the first version of each key valid
    since 1900-01-01 and the open version valid until 9999-12-31."""
    first = F.min(VALID_FROM).over(Window.partitionBy(key))
    return history.select(
        key, *payload,
        F.when(F.col(VALID_FROM) == first, ts_lit(FIRST_VERSION_FROM))
        .otherwise(F.col(VALID_FROM)).alias(_FROM),
        F.coalesce(F.col(VALID_TO), ts_lit(OPEN_VERSION_TO)).alias(_TO),
    )


def heavy_keys(df: DataFrame, key: str, weight: str | None = None,
               parts: int = 64) -> DataFrame:
    """Keys holding at least 1/``parts`` of the total weight (rows if
    ``weight`` is None), with the number of salt values each is spread over.
    At most ``parts`` keys can qualify, so the result is a bounded,
    broadcast-safe relation.  Pass an already-aggregated table (e.g. customer
    metrics with their line counts) to avoid a pass over the facts."""
    if weight is None:  # a heavy key lies in a heavy bucket of keys: only rows of such buckets (at most ``parts``) are counted by key
        bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS_A_PART * parts))
        buckets = df.groupBy(bucket.alias("__hot_bucket")).agg(F.count(F.lit(1)).alias("__w"))
        total = buckets.agg(F.sum("__w")).scalar()      # scalar subquery, computed once
        heavy = F.broadcast(buckets.where(F.col("__w") * parts >= total).select("__hot_bucket"))
        df = df.select(key, bucket.alias("__hot_bucket")).join(heavy, "__hot_bucket", "left_semi")
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__w"))
    else:
        per_key = df.groupBy(key).agg(F.sum(weight).alias("__w"))
        total = per_key.agg(F.sum("__w")).scalar()
    share = F.col("__w") * parts
    return per_key.filter(share >= total).select(
        key, F.ceil(F.try_divide(share, total)).cast("int").alias(SALTS))


def join_as_of(left: DataFrame, ranges: DataFrame, key: str, ts: str,
               payload: list[str], hot: DataFrame | None = None,
               spread_by: Sequence[str] | None = None) -> DataFrame:
    """Left join ``left`` to the version valid at ``left[ts]``; adds ``payload``.

    ``hot`` is the output of ``heavy_keys``; rows of its keys are salted by a
    hash of the columns ``spread_by`` (all of them by default; fewer, if they
    tell rows apart, so that the others are dealt only where they are read).
    A row whose key is null matches no version."""
    others = [c for c in left.columns if c not in (key, ts)]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in spread_by or left.columns])
    salt = F.when(F.col(f"`{key}`").isNull(), F.pmod(spread, F.lit(NULL_KEY_SALTS)))
    # plain columns, the key and the time once: rows stay narrow, and what a consumer does not read is not dealt
    row = [*[F.col(f"`{c}`").alias(f"{_ROW}{i}") for i, c in enumerate(others)], F.col(f"`{key}`").alias(_KEY), F.col(f"`{ts}`").alias(_AT)]
    versions = ranges.where(F.col(key).isNotNull()).select(
        F.col(key).alias(_KEY), F.col(_FROM).alias(_AT), F.struct(_TO, *payload).alias(_VERSION), F.lit(False).alias(_ROW))
    if hot is None:
        rows = left.select(*row, F.coalesce(salt, F.lit(0)).cast("long").alias(_SALT))
        versions = versions.withColumn(_SALT, F.lit(0).cast("long"))
    else:
        heavy = F.broadcast(hot.select(F.col(key).alias("__hot"), F.col(SALTS).alias("__salts")))
        rows = left.join(heavy, left[key] == F.col("__hot"), "left").select(
            *row, F.coalesce(salt, F.pmod(spread, F.col("__salts")), F.lit(0)).cast("long").alias(_SALT))
        versions = versions.join(heavy, F.col(_KEY) == F.col("__hot"), "left").select(
            _KEY, _AT, _VERSION, _ROW,
            F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1)).alias(_SALT))
    merged = versions.unionByName(rows.withColumn(_ROW, F.lit(True)), allowMissingColumns=True)
    # false first: a version comes before the facts of its instant
    started = Window.partitionBy(_KEY, _SALT).orderBy(F.col(_AT).asc_nulls_first(), F.col(_ROW)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = merged.withColumn(_VERSION, F.last(_VERSION, ignorenulls=True).over(started)).where(F.col(_ROW))
    valid = F.col(_AT) < F.col(f"{_VERSION}.{_TO}")
    name = {**{c: f"{_ROW}{i}" for i, c in enumerate(others)}, ts: _AT, key: _KEY}
    return found.select(*[F.col(name[c]).alias(c) for c in left.columns],
                        *[F.when(valid, F.col(f"{_VERSION}.`{p}`")).alias(p) for p in payload])
