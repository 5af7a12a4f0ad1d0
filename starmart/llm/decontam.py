"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the question is containment
``|item & doc| / |item|`` over distinct five-word shingles, not Jaccard.
Items are partitioned by the size of their shingle set (powers of two).  The
MinHash sketch of an item is its ``m`` smallest shingle hashes, with ``m`` set
per partition from its upper size bound ``u`` as ``floor((1 - t) * u) + 1``: an
item of at most ``u`` shingles contained to ``t`` or more misses at most
``m - 1`` shingles, so a leaking document always holds at least one sketch
value.  Candidates are therefore complete, whatever the document's length.
Every candidate is verified by exact containment, on hashes and then on the
shingles' words.

The benchmark is the stated query set: it is taken in blocks of at most
``BLOCK_WORDS`` words, each broadcast to a row-wise pass over the documents, so
documents are never shuffled and the broadcast is bounded at any benchmark size.

Defined cases: a null or empty document or item matches nothing; a text of
fewer than five words is one shingle, its whole word sequence; repeated rows
are each reported; items with equal text are all reported; A-Z are lower-cased,
words are ``[^\\x20\\x09-\\x0D]+``; an empty benchmark or corpus gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, hash_words, rolling, scramble, split_words, text_slices

SHINGLE = 5
THRESHOLD = 0.8
#: Words of the benchmark in one broadcast block: about 16 MB of hashes and 50 MB of words.
BLOCK_WORDS = 1_000_000
BASE = 0x100000001B3
LEAKS = "array<struct<item:long,shared:long,size:long>>"


def shingle_hashes(codes: np.ndarray, starts: np.ndarray, words: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row and their ``starts``; short texts are one shingle."""
    h = hash_words(words)[codes] if len(codes) else np.empty(0, np.uint64)
    n = np.diff(starts)
    runs = np.concatenate((rolling(h, k, BASE), np.zeros(min(k - 1, len(h)), np.uint64)))
    count = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    out = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(out[-1]) - out[row] + starts[row]
    got = runs[at]
    for i in np.flatnonzero((n > 0) & (n < k)):
        got[out[i]] = rolling(h[starts[i]:starts[i + 1]], int(n[i]), BASE)[0] + np.uint64(n[i])
    return scramble(got), out


def word_shingles(words: list[str], k: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


class Index:
    """Sketches, shingle hashes and shingles of one block of items."""

    def __init__(self, keys: list[int], texts: list[str | None], k: int, threshold: float):
        self.k, self.threshold = k, threshold
        self.hashes, self.shingles, self.keys = [], [], []
        codes, starts, words = split_words(pa.array(texts, pa.string()), lower=True)
        h, at = shingle_hashes(codes, starts, words, k)
        names = words.to_pylist()
        sketch, owner = [], []
        for i, key in enumerate(keys):
            own = np.unique(h[at[i]:at[i + 1]])
            if not len(own):
                continue
            upper = 1 << (len(own) - 1).bit_length()  # size partition (u/2, u]
            m = min(len(own), int((1 - threshold) * upper + 1e-9) + 1)
            sketch.append(own[:m])
            owner.append(np.full(m, len(self.keys), np.int32))
            self.keys.append(key)
            self.hashes.append(own)
            self.shingles.append(word_shingles([names[c] for c in codes[starts[i]:starts[i + 1]]], k))
        s = np.concatenate(sketch) if sketch else np.empty(0, np.uint64)
        o = np.concatenate(owner) if owner else np.empty(0, np.int32)
        order = np.argsort(s, kind="stable")
        self.sketch, self.owner = s[order], o[order]

    def search(self, text: pa.Array) -> list[list[dict]]:
        """For each text the items contained in it to the threshold or more."""
        found: list[list[dict]] = []
        for lo, hi in text_slices(text):
            codes, starts, words = split_words(text.slice(lo, hi - lo), lower=True)
            h, at = shingle_hashes(codes, starts, words, self.k)
            left = np.searchsorted(self.sketch, h, side="left")
            hit = np.flatnonzero(self.sketch[np.minimum(left, len(self.sketch) - 1)] == h) if len(self.sketch) else []
            rows: list[list[dict]] = [[] for _ in range(hi - lo)]
            if len(hit):
                row = np.searchsorted(at, hit, side="right") - 1
                for r in np.unique(row):
                    own = np.unique(h[hit[row == r]])
                    a, b = np.searchsorted(self.sketch, own, "left"), np.searchsorted(self.sketch, own, "right")
                    items = sorted({int(x) for i, j in zip(a, b) for x in self.owner[i:j]})
                    rows[r] = self.verify(items, h[at[r]:at[r + 1]], codes[starts[r]:starts[r + 1]], words)
            found += rows
        return found

    def verify(self, items: list[int], h: np.ndarray, codes: np.ndarray, words: pa.Array) -> list[dict]:
        there, held, out = np.unique(h), None, []
        for i in items:
            size = len(self.shingles[i])
            if np.isin(self.hashes[i], there, assume_unique=True).sum() < self.threshold * size - 1e-9:
                continue
            if held is None:
                held = word_shingles(words.take(pa.array(codes)).to_pylist(), self.k)
            shared = len(self.shingles[i] & held)
            if shared >= self.threshold * size - 1e-9:
                out.append({"item": self.keys[i], "shared": shared, "size": size})
        return out


def leak_column(text: Column, blocks: list[Index], spark) -> Column:
    """Column of the leaks in ``text``: one Arrow UDF for each benchmark block."""
    kind = pa.list_(pa.struct([("item", pa.int64()), ("shared", pa.int64()), ("size", pa.int64())]))
    out = F.array().cast(LEAKS)

    def search(held):
        def leaks(t: pa.Array) -> pa.Array:
            return pa.array(held.value.search(t), kind)

        return leaks

    for block in blocks:
        out = F.concat(out, F.arrow_udf(search(spark.sparkContext.broadcast(block)), LEAKS)(text))
    return out


def build_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = SHINGLE,
                 threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> list[Index]:
    """Indexes over the whole benchmark, each of about ``block_words`` words."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = int(total // (6 * block_words)) + 1
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    blocks = []
    for b in range(n):
        rows = items.where(part == b).orderBy("i", "t").collect() if n > 1 else items.orderBy("i", "t").collect()
        blocks.append(Index([r[0] for r in rows], [r[1] for r in rows], k, threshold))
    return blocks


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", k: int = SHINGLE,
               threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (doc_id, item_id, shared, size, containment) with containment >= ``threshold``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = build_blocks(benchmark, item_col, item_text_col, k, threshold)
    d = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    got = d.select("doc_id", leak_column(F.col("text"), blocks, spark).alias("leaks"))
    # explode_outer: no filter is inferred below it, which would search every text twice
    return got.select("doc_id", F.explode_outer("leaks").alias("l")).where("l is not null").select(
        "doc_id", F.col("l.item").alias("item_id"), F.col("l.shared").alias("shared"), F.col("l.size").alias("size"),
        (F.col("l.shared") / F.col("l.size")).alias("containment"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the rows in which a benchmark item leaks."""
    spark = docs.sparkSession
    bounded_batches(spark)
    leaks = leak_column(F.col(text_col), build_blocks(benchmark), spark)
    return docs.where(F.size(leaks) == 0)
