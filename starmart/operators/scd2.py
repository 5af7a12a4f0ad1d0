"""Type-2 history ("check" strategy) and current-state dimensions.

A batch compares the source rows with the *open* versions only, on the
natural key, with null-safe inequality over the check columns:

* key not open yet          -> new version  (valid_from = batch_ts)
* any check column differs  -> close the open version (valid_to = batch_ts)
                               and open a new one with the source values
* unchanged                 -> the open version stays as it is
* open key missing in source-> stays open (deletes are not propagated)

Closed versions never change again, so the history is kept as two parts:
``closed`` (append-only) and ``open`` (one row per key, replaced per batch).
A batch therefore shuffles the open part and the source once each (one
sort-merge or hash join on the key); closed rows are never rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import ts_lit

SCD_ID = "dbt_scd_id"
UPDATED_AT = "dbt_updated_at"
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
META = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)

_S = "__src_"
PART = "__part"


@dataclass(frozen=True)
class HistoryBatch:
    """Result of one snapshot batch: rows to append to the closed part and the
    complete new open part."""

    newly_closed: DataFrame
    open: DataFrame
    combined: DataFrame | None = None      # both parts, tagged with ``PART``


def _scd_id(key: str, ts: Column) -> Column:
    """md5 of the natural key and the batch time."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")),
                             F.coalesce(ts.cast("string"), F.lit(""))))


def _as_version(src: DataFrame, key: str, batch_ts: dt.datetime) -> DataFrame:
    ts = ts_lit(batch_ts)
    return src.select(
        *src.columns,
        _scd_id(key, ts).alias(SCD_ID),
        ts.alias(UPDATED_AT),
        ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def snapshot_check(open_rows: DataFrame | None, source: DataFrame, key: str,
                   check_cols: Sequence[str], batch_ts: dt.datetime) -> HistoryBatch:
    """One snapshot batch against the open versions (``None`` = first run)."""
    if open_rows is None:
        first = _as_version(source, key, batch_ts)
        return HistoryBatch(first.where(F.lit(False)), first, first.withColumn(PART, F.lit("open")))

    cols = source.columns
    src = source.select(*[F.col(c).alias(_S + c) for c in cols])
    j = open_rows.join(src, open_rows[key] == src[_S + key], "full_outer")
    in_open = F.col(key).isNotNull()
    in_src = F.col(_S + key).isNotNull()
    changed = reduce(lambda a, b: a | b,
                     [~F.col(c).eqNullSafe(F.col(_S + c)) for c in check_cols])
    ts = ts_lit(batch_ts)
    meta = {SCD_ID: _scd_id(_S + key, ts), UPDATED_AT: ts, VALID_FROM: ts,
            VALID_TO: F.lit(None).cast("timestamp_ntz")}
    out_cols = open_rows.columns

    def version(part: str, values: dict) -> Column:
        return F.struct(F.lit(part).alias(PART), *[values[c].alias(c) for c in out_cols])

    as_open = {c: F.col(c) for c in out_cols}
    as_closed = {**as_open, VALID_TO: ts}
    as_new = {**{c: F.col(_S + c) for c in cols}, **meta}
    # one pass over the join: each key yields its kept, closed and/or new version
    candidates = F.array(
        F.when(in_open & (~in_src | ~changed), version("open", as_open)),
        F.when(in_open & in_src & changed, version("closed", as_closed)),
        F.when(in_src & (~in_open | changed), version("open", as_new)),
    )
    versions = j.select(F.explode(F.filter(candidates, lambda v: v.isNotNull())).alias("v")) \
        .select("v.*")
    return HistoryBatch(versions.filter(F.col(PART) == "closed").drop(PART),
                        versions.filter(F.col(PART) == "open").drop(PART), versions)


def current_rows(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Current-state dimension: the open version of every key."""
    return history.filter(F.col(VALID_TO).isNull()).select(
        *columns, F.col(UPDATED_AT).alias("snapshot_updated_at"))
