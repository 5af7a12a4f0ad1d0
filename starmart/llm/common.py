"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from starmart.session import scratch_path

#: Text handled at once inside a Python task; a single longer text is a slice of its own.
SLICE_BYTES = 8 << 20
#: Bytes of one Arrow batch sent to a Python worker (rows can be 100 KB and more).
ARROW_BATCH_BYTES = 16 << 20
try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, limit: int = ARROW_BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes as well as by rows, so that long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(limit))


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes of text (one row at least)."""
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, lo = np.cumsum(size), 0
    while lo < len(size):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield lo, hi
        lo = hi


def release() -> None:
    """Give memory freed by the last slice back: Arrow's pool and the C heap keep it otherwise, and workers are reused."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def split_words(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none), optionally with A-Z lower-cased.

    Returns word codes of all texts in a row, ``starts`` (row i holds codes
    ``starts[i]:starts[i + 1]``) and the dictionary of distinct words.
    """
    text = pc.fill_null(text, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    ends = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # white space at either end of a text, or an empty text
        real = codes != empty
        ends = np.concatenate(([0], np.cumsum(real)))[ends]
        codes = codes[real]
    return codes, ends.astype(np.int64), words


def hash_words(words: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each distinct word."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes (mod 2^64) of every run of ``k`` consecutive values.

    Built by doubling: a run of 2m is two runs of m, the first times base^m.
    """
    if len(h) < k:
        return np.empty(0, np.uint64)
    out: np.ndarray | None = None
    done, part, m = 0, h, 1
    while True:
        if k & m:
            n = len(h) - done - m + 1
            if out is None:
                out = part[:n].copy()
            else:
                out = out[:n] * np.uint64(pow(base, m, 1 << 64)) + part[done:done + n]
            done += m
        if m * 2 > k:
            return out[: len(h) - k + 1]
        part = part[:-m] * np.uint64(pow(base, m, 1 << 64)) + part[m:]
        m *= 2


def scramble(h: np.ndarray) -> np.ndarray:
    """Bit mixer (multiply, xor-shift) so that low and high bits are equally random."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the column ``text`` by ``packed``: its UTF-8 bytes under zstd (null stays null), for shuffles of whole texts."""
    for b in batches:
        at = b.schema.get_field_index("text")
        out = []
        for t in b.column(at).cast(pa.binary()):  # a row at a time: no second copy of a batch's texts
            raw = t.as_buffer()
            out.append(None if raw is None else raw.size.to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True))
        yield b.set_column(at, "packed", pa.array(out, pa.binary()))
        release()


def unpack(packed: pa.Array) -> pa.Array:
    """Texts of a ``packed`` column."""
    raw = [None if t is None else pa.decompress(t[8:], int.from_bytes(t[:8], "little"), "zstd", asbytes=True) for t in packed.to_pylist()]
    return pa.array(raw, pa.binary()).cast(pa.string())


def squeeze(numbers: np.ndarray) -> bytes:
    """Bytes of an integer array by place value (all lowest bytes first, and so on), under zstd."""
    raw = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T).tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data[8:], n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).reshape(-1).view(kind)
