"""Bloom filters of fixed size: a semi-join that ships no rows.

What a filter lets through by chance is left to an exact step after it, so
results do not depend on its size; a full filter only saves nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bits of a filter (8 MB, the only thing broadcast) and positions of each key in it
FILTER_BITS = 1 << 26
PROBES = 4


def hash_longs(values: np.ndarray) -> np.ndarray:
    """XXH64 of rows of 64-bit integers, chained from seed 42, as Spark's ``xxhash64`` has it."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = np.full(len(values), 42, np.uint64)
    for x in values.T.view(np.uint64):
        k = x * p2
        k = (k << np.uint64(31) | k >> np.uint64(33)) * p1
        h = (h + p5 + np.uint64(8)) ^ k
        h = (h << np.uint64(27) | h >> np.uint64(37)) * p1 + p4
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        h ^= h >> np.uint64(32)
    return h


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which rows of ``keys`` may be in the filter; none that is in it is missed."""
    h = hash_longs(np.ascontiguousarray(keys))
    low, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    found = np.ones(len(h), bool)
    for i in range(PROBES):
        at = (low + np.uint64(i) * step) % np.uint64(FILTER_BITS)
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found


def key_filter(rows: DataFrame, key: list[str]) -> np.ndarray:
    """Bloom filter of the rows' keys (long columns): ``FILTER_BITS`` bits, put together in Spark in pieces of 4 KB."""
    h = F.xxhash64(*key)
    low, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*[(low + i * step) % FILTER_BITS + 1 for i in range(PROBES)]))  # bitmaps number bits from 1
    pieces = rows.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in pieces.collect():  # at most FILTER_BITS / 32768 rows
        out[(r.piece - 1) * 4096:r.piece * 4096] = np.frombuffer(r.bits, np.uint8)
    return out
