"""Surrogate keys: lower-case hex md5 over the key columns rendered as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str, null_token: str = "") -> Column:
    """md5 of the columns cast to text, NULL parts replaced by ``null_token``,
    joined with '-'.  Deterministic, so every version of an entity shares it."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                   F.lit(null_token))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


_PLAIN = b"\0" * 17


def packed_key(key: Column | str) -> Column:
    """A text key as bytes for a shuffle: a hash of 32 lower-case hex digits as its 16 bytes, any other text behind 17 zeros."""
    c = F.col(key) if isinstance(key, str) else key
    return F.when(c.rlike("^[0-9a-f]{32}$"), F.unhex(c)).otherwise(F.concat(F.lit(_PLAIN), F.encode(c, "UTF-8")))


def unpacked_key(key: Column | str) -> Column:
    """The text that ``packed_key`` packed."""
    c = F.col(key) if isinstance(key, str) else key
    return F.when(F.length(c) == 16, F.lower(F.hex(c))).otherwise(F.decode(F.substring(c, len(_PLAIN) + 1, 1 << 30), "UTF-8"))
