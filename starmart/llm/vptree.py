"""SimHash near-duplicates by sharded vantage-point trees.

Fingerprint: a bit is 1 if it is set in over half of the XXH64 values (seed 42)
of the text's word shingles, repeats included.

Two fingerprints within ``radius`` bits agree to within ``radius // parts`` bits
on at least one of ``parts`` disjoint bit ranges (pigeonhole).  Each range has
its own vantage-point tree over the Hamming distance on that range: a node
holds a vantage value and a distance ``cut``; a fingerprint at distance ``d``
belongs inside if ``d <= cut``.  By the triangle inequality a neighbour within
``r`` bits of a query can be inside only if ``d <= cut + r`` and outside only if
``d > cut - r``: all other branches are pruned.

The upper levels of each tree, fitted on a bounded sample, are the shards:
every distinct fingerprint is stored in one shard and asked in each shard whose
boundary it overlaps.  In a shard the tree goes on (splitting stored and asking
fingerprints together) until few are left, which are compared exactly.  Shards
hold distinct fingerprints only, so a group of equal texts is one entry, and a
shard returns star edges of its local components, never all pairs.  Shards grow
in number with the data (about ``SHARD`` stored fingerprints each).

Defined cases: a null text or one without words has fingerprint zero and links
like any other; fewer words than a shingle: the whole sequence is one; repeated
rows share a fingerprint; a null doc_id never becomes a component id unless its
component has no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, materialize
from starmart.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
PARTS = 3
SHARD = 1 << 16  # stored fingerprints a shard aims at
SAMPLE_PER_SHARD = 64
LEAF = 48
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the XXH64 values of the text's ``k``-word shingles."""
    words = text.lower().split() if text else []  # bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    run = b" ".join(words)
    if len(words) <= k:
        return h64(run, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first = (end - size)[: len(words) - k + 1].tolist()
    h = np.fromiter((h64(run[a:b], seed) for a, b in zip(first, end[k - 1:].tolist())), np.uint64, len(first))
    octets, out = h.view(np.uint8).reshape(-1, 8), 0
    for byte in range(8):
        votes = np.bincount(octets[:, byte], minlength=256) @ _BITS
        out |= int(np.packbits(2 * votes > len(h), bitorder="little")[0]) << (8 * byte)
    return out


def fingerprint_column(text: Column, k: int = SHINGLE) -> Column:
    def run(t: pa.Array) -> pa.Array:
        got = np.fromiter((fingerprint(x, k) for x in (y.as_py() for y in t.cast(pa.binary()))), np.uint64, len(t))
        return pa.array(got.view(np.int64))

    return F.arrow_udf(run, "long")(text)


@dataclass
class Node:
    """Branch (vantage, cut, inside, outside) or, with a shard number, a leaf."""

    vantage: int = 0
    cut: int = -1
    inside: Node | None = None
    outside: Node | None = None
    shard: int = -1


def _distance(x: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((x ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)


def _split(x: np.ndarray, mask: int, at: int) -> tuple[int, int, np.ndarray] | None:
    """A vantage (a stored value, chosen by ``at``) and the cut that halves ``x`` best; None if nothing separates."""
    for k in range(4):
        vantage = int(x[(at * 2654435761 + k * 40503) % len(x)])
        d = _distance(x, vantage, mask)
        upto = np.cumsum(np.bincount(d, minlength=65))
        cut = int(np.abs(2 * upto - len(x)).argmin())
        if 0 < upto[cut] < len(x):
            return vantage, cut, d
    return None


def build(sample: np.ndarray, mask: int, shards: int) -> Node:
    """Tree with up to ``shards`` leaves over ``sample``; leaves are numbered in order."""
    number = iter(range(1 << 30))

    def grow(x: np.ndarray, leaves: int, at: int) -> Node:
        parted = _split(x, mask, at) if leaves > 1 and len(x) > 1 else None
        if parted is None:
            return Node(shard=next(number))
        vantage, cut, d = parted
        return Node(vantage, cut, grow(x[d <= cut], leaves // 2, 2 * at), grow(x[d > cut], leaves - leaves // 2, 2 * at + 1))

    return grow(sample, shards, 1)


def route(node: Node, x: np.ndarray, mask: int, r: int, rows: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, rows, is home) for every shard whose region comes within ``r`` of a fingerprint."""
    if not len(rows):
        return
    if node.shard >= 0:
        yield node.shard, rows, home
        return
    d = _distance(x[rows], node.vantage, mask)
    a, b = d <= node.cut + r, d > node.cut - r
    yield from route(node.inside, x, mask, r, rows[a], home[a] & (d[a] <= node.cut))
    yield from route(node.outside, x, mask, r, rows[b], home[b] & (d[b] > node.cut))


def merge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node) of the components of the edges (a, b)."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    star = root != np.arange(len(nodes))
    return nodes[star], nodes[root[star]]


def linked(stored: np.ndarray, asking: np.ndarray, mask: int, r: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges over all pairs (stored, asking) within ``radius`` bits that agree to ``r`` bits on ``mask``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    todo = [(stored, asking, 1)]
    while todo:
        s, q, at = todo.pop()
        if not len(s) or not len(q):
            continue
        parted = _split(s, mask, at) if len(s) > LEAF else None
        if parted is None:
            step = max(1, (1 << 20) // len(s))
            for i in range(0, len(q), step):
                near = np.bitwise_count(q[i:i + step, None] ^ s[None, :]) <= radius
                j, k = np.nonzero(near)
                a, b = q[i + j], s[k]
                real = a != b
                if real.any():
                    found.append((a[real], b[real]))
                    held += int(real.sum())
            if held > 1 << 20:  # keep edges of the local components only
                found = [merge(*map(np.concatenate, zip(*found)))]
                held = len(found[0][0]) // 2
            continue
        vantage, cut, d = parted
        e = _distance(q, vantage, mask)
        todo.append((s[d <= cut], q[e <= cut + r], 2 * at))
        todo.append((s[d > cut], q[e > cut - r], 2 * at + 1))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return merge(*map(np.concatenate, zip(*found)))


def masks(parts: int) -> list[int]:
    """Disjoint bit ranges that cover all 64 bits."""
    edge = [64 * i // parts for i in range(parts + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]


def near_pairs(fingerprints: DataFrame, radius: int = RADIUS, parts: int = PARTS, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) whose components are those of all distinct ``fp`` values within ``radius`` bits.

    ``fingerprints`` holds distinct values.  The sample behind the shards has
    ``SAMPLE_PER_SHARD`` values a shard (smallest by hash): 1/1024 of the values.
    """
    n = fingerprints.count()
    shards = -(-n // shard) if n else 1
    taken = fingerprints.orderBy(F.xxhash64("fp"), "fp").limit(shards * SAMPLE_PER_SHARD).toPandas()["fp"]
    sample = taken.to_numpy(np.int64).view(np.uint64)
    bits, r = masks(parts), radius // parts
    trees = fingerprints.sparkSession.sparkContext.broadcast([build(sample, m, shards) if len(sample) else Node(shard=0) for m in bits])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("fp").to_numpy().view(np.uint64)
            for p, m in enumerate(bits):
                for s, rows, home in route(trees.value[p], x, m, r, np.arange(len(x)), np.ones(len(x), bool)):
                    yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(rows), p, np.int32)), "shard": pa.array(np.full(len(rows), s, np.int32)),
                                                      "fp": pa.array(x[rows].view(np.int64)), "home": pa.array(home)})

    def search(t: pa.Table) -> pa.Table:
        x, home = t.column("fp").to_numpy().view(np.uint64), t.column("home").to_numpy(zero_copy_only=False)
        m = bits[t.column("part")[0].as_py()]
        order = np.argsort(x, kind="stable")
        x, home = x[order], home[order]
        a, b = linked(x[home], x, m, r, radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    routed = fingerprints.select("fp").mapInArrow(spread, "part int, shard int, fp long, home boolean")
    return routed.groupBy("part", "shard").applyInArrow(search, "a long, b long")


def group_by_fingerprint(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Adds ``root`` (a fingerprint of the component) and ``component_id`` to rows (doc_id, fp)."""
    least = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = materialize(components(near_pairs(least.select("fp"), radius), "simhash-stars"), "simhash-roots")
    to = least.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    to = materialize(to, "simhash-labels")
    ids = to.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = to.select("fp", "root").join(ids, "root").select(F.col("fp").alias("lfp"), "root", "component_id")
    return docs.join(labels, F.col("fp") == F.col("lfp")).drop("lfp")


def simhash_groups(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row."""
    bounded_batches(docs.sparkSession)
    rows = materialize(docs.select(F.col(doc_col).alias("doc_id"), fingerprint_column(F.col(text_col), k).alias("fp")), "simhash")
    return group_by_fingerprint(rows, radius)


def keep_one(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (all columns) with one document of each group: the smallest doc_id."""
    bounded_batches(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = materialize(docs.select(row.alias("row"), F.col("doc_id"), F.xxhash64(row).alias("rid"),
                                   fingerprint_column(F.col("text"), k).alias("fp")), "simhash-rows")
    ids = group_by_fingerprint(rows.select("doc_id", "fp", "rid"), radius)
    first = ids.where("doc_id <=> component_id").groupBy("root").agg(F.min(F.struct("fp", "rid")).alias("first"))
    first = first.select(F.col("first.fp").alias("kfp"), F.col("first.rid").alias("krid"))
    kept = rows.join(first, (F.col("fp") == F.col("kfp")) & (F.col("rid") == F.col("krid")))
    return kept.groupBy("fp", "rid").agg(F.first("row").alias("row")).select("row.*")  # equal rows repeated: once
