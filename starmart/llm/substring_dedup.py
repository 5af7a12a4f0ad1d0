"""Substring dedup: repeated windows of ``WINDOW`` words become removal intervals.

Every window of 50 consecutive words has a Rabin-Karp hash.  Counting all of
them would shuffle several times the input, so exact reductions come first:

1. Equal texts collapse: of a group of copies only those with the smallest id go
   on; every window of the others starts in a document with a smaller id.
2. A window is represented by its minimizer, the smallest of the Rabin-Karp
   hashes of its 20-word runs.  Equal windows have equal minimizers, so a window
   whose minimizer occurs in one text only cannot repeat.  Minimizers are 1/14 of
   the words; Spark counts them, with the smallest document (leader) of each.
3. The windows of one minimizer occurrence travel as one row.  A window that is
   also one of its leader's is settled there; no document is before the leader.
4. The rest, windows that their leader lacks, are counted one by one: the
   smallest document of each (minimizer, window) pair of 64-bit hashes.

Removed windows merge into maximal intervals of words.

Hot passages: the counts are aggregates with a map-side step, and every way back
is an equi-join whose other side is unique and written first (an aggregate in the
join's own stage would keep adaptive execution from splitting it), so that a hash
that holds many rows is split, or the small side broadcast by its known size.  No group is gathered but the windows of one document.
Whole texts are shuffled under zstd.

Defined cases: a null text has no words; a text shorter than a window loses
nothing; repeated rows with one doc_id do not remove each other (no smaller
id); rows with a null doc_id neither lose words nor remove any; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import (bounded_batches, hash_words, materialize, pack, release, rolling, scramble, split_words,
                                 text_slices, unpack)

#: text handled at once, and Arrow batch, in bytes
SLICE_BYTES = 4 << 20
WINDOW = 50
RUN = 20
BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)


def _minimizers(h: np.ndarray, starts: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, minimizer of each, its position): windows inside one document only."""
    n = np.diff(starts)
    count = np.maximum(n - window + 1, 0)
    if not count.sum():
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    row = np.repeat(np.arange(len(n)), count)
    first = np.arange(count.sum()) - (np.cumsum(count) - count)[row] + starts[row]
    runs = scramble(rolling(h, run, BASES[0]))
    view = np.lib.stride_tricks.sliding_window_view(runs, window - run + 1)
    least = np.empty(len(first), np.int64)
    for i in range(0, len(first), 1 << 18):
        at = first[i:i + (1 << 18)]
        least[i:i + (1 << 18)] = at + view[at[0]:at[-1] + 1][at - at[0]].argmin(axis=1)
    return first, runs[least], least


def _anchors(window: int, run: int):
    kind = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("h", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("text")
            for lo, hi in text_slices(text, SLICE_BYTES):
                codes, starts, words = split_words(text.slice(lo, hi - lo))
                h = hash_words(words)[codes] if len(codes) else np.empty(0, np.uint64)
                _, value, at = _minimizers(h, starts, window, run)
                at, one = np.unique(at, return_index=True)
                row = lo + np.searchsorted(starts, at, side="right") - 1
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("tkey").take(take),
                                                  pa.array(value[one].view(np.int64))], schema=kind)
                release()

    return scan


def _member(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One number for (row, value): rows of a batch are few, values random."""
    return scramble(value + scramble(row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C55)))


def _windows(window: int, run: int):
    """A row for each occurrence of a shared minimizer: its windows start at ``pos``, ``pos + 1``, ..."""
    kind = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("leads", pa.bool_()), ("pos", pa.int32()),
                      ("v", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, hits = unpack(b.column("packed")), b.column("hits")
            for lo, hi in text_slices(text, SLICE_BYTES):
                codes, starts, words = split_words(text.slice(lo, hi - lo))
                h = hash_words(words)[codes] if len(codes) else np.empty(0, np.uint64)
                first, value, least = _minimizers(h, starts, window, run)
                if not len(first):
                    continue
                row = np.searchsorted(starts, first, side="right") - 1
                own = hits.slice(lo, hi - lo)
                shared = own.flatten()
                leader = shared.field("lo").to_numpy()
                shared = _member(pc.list_parent_indices(own).to_numpy(), shared.field("h").to_numpy().view(np.uint64))
                order = np.argsort(shared)
                shared, leader = shared[order], leader[order]
                mine = _member(row, value)
                at = np.minimum(np.searchsorted(shared, mine), len(shared) - 1)
                wanted = shared[at] == mine
                first, value, least, row, leader = first[wanted], value[wanted], least[wanted], row[wanted], leader[at[wanted]]
                if not len(first):
                    continue
                w = rolling(hash_words(words, 7)[codes], window, BASES[1])[first]
                v = scramble(w + (least - first).astype(np.uint64))
                new = np.concatenate(([True], (least[1:] != least[:-1]) | (first[1:] != first[:-1] + 1)))
                begin = np.flatnonzero(new)
                take = pa.array(lo + row[begin])
                doc = b.column("doc_id").take(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[begin].view(np.int64)), doc, b.column("tkey").take(take), pa.array(doc.to_numpy() == leader[begin]),
                     pa.array((first - starts[row])[begin].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.append(begin, len(v)).astype(np.int32)), pa.array(v.view(np.int64)))], schema=kind)
                release()

    return scan


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of followers' windows: starts of those that the leader has, and (start, v) of the others."""
    other = pa.struct([("pos", pa.int32()), ("v", pa.int64())])
    for b in batches:
        v, lead = b.column("v"), b.column("lead")
        row = pc.list_parent_indices(v).to_numpy()
        value = v.flatten().to_numpy()
        pos = b.column("pos").to_numpy()[row] + np.arange(len(row)) - np.searchsorted(row, row)
        held = np.isin(_member(row, value.view(np.uint64)), _member(pc.list_parent_indices(lead).to_numpy(), lead.flatten().to_numpy().view(np.uint64)))

        def lists(of: np.ndarray, values: pa.Array) -> pa.Array:
            at = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=b.num_rows))))
            return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)

        rest = pa.StructArray.from_arrays([pa.array(pos[~held].astype(np.int32)), pa.array(value[~held])], fields=list(other))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tkey"), b.column("h"), lists(row[held], pa.array(pos[held].astype(np.int32))),
                                          lists(row[~held], rest)], names=["doc_id", "tkey", "h", "gone", "rest"])


def removal_windows(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, tkey, positions, whole): starts of the windows to remove; ``whole``: the text is a later copy, all of them.

    ``docs`` has doc_id, tkey, text.
    """
    docs = docs.where("doc_id is not null")
    texts = docs.select("doc_id", "tkey", F.xxhash64("text", F.lit(1)).alias("tkey2"))
    first = texts.groupBy("tkey", "tkey2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    first = materialize(first, "first")
    copies = materialize(texts.join(first, ["tkey", "tkey2"]).where("doc_id > least").select("doc_id", "tkey").distinct(), "copies")

    anchors = materialize(docs.select("doc_id", "tkey", "text").mapInArrow(_anchors(window, run), "doc_id long, tkey long, h long"), "anchors")
    shared = anchors.groupBy("h").agg(F.min("doc_id").alias("lo"), F.min("tkey").alias("a"), F.max("tkey").alias("b")).where("a < b").select("h", "lo")
    shared = materialize(shared, "shared")
    hits = anchors.join(shared, "h").groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("h", "lo")).alias("hits"))
    hits = hits.join(copies, ["doc_id", "tkey"], "left_anti")
    packed = docs.select("doc_id", "tkey", "text").mapInArrow(pack, "doc_id long, tkey long, packed binary")
    windows = materialize(packed.join(hits, ["doc_id", "tkey"]).select("doc_id", "tkey", "packed", "hits").mapInArrow(
        _windows(window, run), "h long, doc_id long, tkey long, leads boolean, pos int, v array<long>"), "windows")

    lead = windows.where("leads").groupBy("h").agg(F.flatten(F.collect_list("v")).alias("lead"))
    lead = materialize(lead, "lead")
    settled = windows.where("not leads").select("h", "doc_id", "tkey", "pos", "v").join(lead, "h").mapInArrow(
        _settle, "doc_id long, tkey long, h long, gone array<int>, rest array<struct<pos:int,v:long>>")
    settled = materialize(settled, "settled")
    rest = settled.where(F.size("rest") > 0).select("doc_id", "tkey", "h", F.explode("rest").alias("r")).select("doc_id", "tkey", "h", "r.v", "r.pos")
    least = rest.groupBy("h", "v").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h", "v", "lo")
    least = materialize(least, "least")
    late = rest.join(least, ["h", "v"]).where("doc_id > lo").groupBy("doc_id", "tkey").agg(F.collect_list("pos").alias("gone"))
    gone = settled.where(F.size("gone") > 0).select("doc_id", "tkey", "gone").unionByName(late)
    gone = gone.groupBy("doc_id", "tkey").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("positions"))
    return gone.withColumn("whole", F.lit(False)).unionByName(copies.select(
        "doc_id", "tkey", F.array().cast("array<int>").alias("positions"), F.lit(True).alias("whole")))


def intervals(positions: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal half-open word intervals covered by windows that start at ``positions``."""
    if not len(positions):
        return []
    p = np.sort(positions)
    new = np.concatenate(([True], p[1:] > p[:-1] + window))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(p) - 1]))
    return [(int(a), int(b) + window) for a, b in zip(p[new], p[last])]


def _apply(window: int):
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("spans", spans)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, positions, whole = unpack(b.column("packed")), b.column("positions"), b.column("whole")
            for lo, hi in text_slices(text, SLICE_BYTES):
                total, removed, kept, out = [], [], [], []
                for t, p, every in zip(text.slice(lo, hi - lo).cast(pa.binary()).to_pylist(), positions.slice(lo, hi - lo),
                                       whole.slice(lo, hi - lo).to_pylist()):
                    words = (t or b"").split()
                    gaps = intervals(np.array(p.as_py() or [], np.int64), window)
                    if every and len(words) >= window:
                        gaps = [(0, len(words))]
                    total.append(len(words))
                    left = 0
                    rest: list[bytes] = []
                    for a, e in gaps:
                        rest += words[left:a]
                        left = e
                    rest += words[left:]
                    removed.append(len(words) - len(rest))
                    kept.append(b" ".join(rest).decode())
                    out.append([{"first": a, "end": e} for a, e in gaps])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.string()), pa.array(out, spans)], schema=kind)
                release()

    return cut


def dedup_substrings(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans) for every row: kept words joined by one space, removed word intervals."""
    bounded_batches(docs.sparkSession, SLICE_BYTES)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tkey"))
    gone = removal_windows(d, window, run).select(F.col("doc_id").alias("gd"), F.col("tkey").alias("gt"), "positions", "whole")
    out = d.mapInArrow(pack, "doc_id long, packed binary, tkey long").join(
        gone, (F.col("doc_id") == F.col("gd")) & (F.col("tkey") == F.col("gt")), "left").select("doc_id", "packed", "positions", "whole")
    return out.mapInArrow(_apply(window), "doc_id long, n_words long, n_removed long, kept string, spans array<struct<first:int,end:int>>")

