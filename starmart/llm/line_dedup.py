"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, connected groups.

Lines are normalised (lower case; every run of characters that are not letters,
marks or numbers becomes one space; trimmed) and fingerprinted by a 64-bit
SimHash of their words.  Two distinct lines are linked if their fingerprints
differ in at most ``RADIUS`` bits and the edit similarity of the normalised
lines, ``1 - levenshtein / longer length``, is at least 0.8.

Candidates: 64 bits in five blocks; three differing bits leave two blocks equal,
so ten tables, one for each pair of blocks, join on 25 or 26 equal bits and find
every pair within the radius.  Equal lines collapse before the join.  Buckets are
spread over groups of about 65,536 rows (their number grows with the data), to
which a task deals its fingerprints packed, one row a group;
fingerprints of a bucket are compared in numpy, lines with a partner get their
text, links are verified there, and only star edges of the verified links'
components leave the task, never all pairs.

Of each connected group one occurrence stays: the first by (doc_id, line
number).  A distinct line that occurs once and has no link stays without
further ado; only the others meet their groups and occurrences.  Lines without a letter, mark or number are never duplicates.

Defined cases: a null text has no lines; an empty text has one empty line;
null doc_ids order first; rows with equal doc_id are told apart by a hash of
their text, and equal rows repeated count as one document with one decision;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bloom import in_filter, key_filter
from starmart.llm.common import (bounded_batches, hash_words, materialize, pack, release, scramble, split_words, squeeze, text_slices,
                                 unpack, unsqueeze)
from starmart.llm.components import components

RADIUS = 3
BLOCKS = (13, 13, 13, 13, 12)
SIMILARITY = 0.8
#: fingerprints that a task deals at once
DEALT = 1 << 18


def normalise(lines: pa.Array) -> pa.Array:
    return pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(lines), r"[^\p{L}\p{M}\p{N}]+", " "))


def simhash(codes: np.ndarray, starts: np.ndarray, words: pa.Array) -> np.ndarray:
    """64-bit SimHash of each row's words, every occurrence one vote; a bit is 1 if set in over half of them."""
    n = len(starts) - 1
    if not len(codes):
        return np.zeros(n, np.uint64)
    h = scramble(hash_words(words))[codes]
    out = np.zeros(n, np.uint64)
    size = np.diff(starts)
    full = size > 0
    at, size = starts[:-1][full], size[full]
    # bits j, j + lane, ... of all hashes are counted in one sum: 64 / lane counters side by side
    lane = 16 if size.max() < 1 << 16 else 32
    ones = np.uint64(sum(1 << k for k in range(0, 64, lane)))
    for j in range(lane):
        votes = np.add.reduceat(h >> np.uint64(j) & ones, at)
        for k in range(0, 64, lane):
            count = (votes >> np.uint64(k)) & np.uint64((1 << lane) - 1)
            out[full] |= (2 * count.astype(np.int64) > size).astype(np.uint64) << np.uint64(j + k)
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tkey, line, h1, h2, sim, size): one row for each line with a letter, mark or number."""
    names = ["doc_id", "tkey", "line", "h1", "h2", "sim", "size"]
    for b in batches:
        text = b.column("text")
        for lo, hi in text_slices(text):
            lists = pc.split_pattern(text.slice(lo, hi - lo), "\n")
            norm = normalise(lists.flatten())
            owner = pc.list_parent_indices(lists).to_numpy()
            number = np.arange(len(owner)) - np.searchsorted(owner, owner)
            real = np.flatnonzero(pc.not_equal(norm, "").to_numpy(zero_copy_only=False))
            norm, owner, number = norm.take(pa.array(real)), owner[real], number[real]
            raw = norm.cast(pa.binary()).to_pylist()
            both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in raw), np.int64).reshape(-1, 2)
            sim = simhash(*split_words(norm))
            take = pa.array(owner + lo)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("tkey").take(take), pa.array(number.astype(np.int32)),
                                              pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(sim.view(np.int64)),
                                              pc.cast(pc.utf8_length(norm), pa.int32())], names=names)
            release()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tkey, line, norm) of the wanted line numbers."""
    for b in batches:
        wanted, raw, owner = [], [], []
        for i, (text, lines) in enumerate(zip(unpack(b.column("packed")).to_pylist(), b.column("lines").to_pylist())):
            parts = text.split("\n")
            wanted += lines
            raw += [parts[x] for x in lines]
            owner += [i] * len(lines)
        take = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("tkey").take(take), pa.array(wanted, pa.int32()),
                                          normalise(pa.array(raw, pa.string()))], names=["doc_id", "tkey", "line", "norm"])


#: bit range of each block, and the two ranges of each table as one mask
_EDGES = np.concatenate(([0], np.cumsum(BLOCKS))).tolist()
_RANGES = [((1 << (b - a)) - 1) << a for a, b in zip(_EDGES, _EDGES[1:])]
TABLES = [x | y for x, y in combinations(_RANGES, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _among(bits, inside: bool = True):
    """``pack`` of the rows whose text hash may be (``inside``) or is not in a filter; those not in it keep their text as it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            found = in_filter(held, b.column("tkey").to_numpy()[:, None])
            part = b.filter(pa.array(found == inside))
            if part.num_rows:
                yield from pack(iter([part])) if inside else iter([part])

    return run


def _deal(n_groups: int):
    """(g, n, sim): fingerprints under each table number ``n``, packed in one row for each group ``g`` of buckets (equal bits of two blocks)."""
    def rows(sim: np.ndarray) -> pa.RecordBatch:
        g = np.concatenate([scramble(scramble(sim & np.uint64(m)) + np.uint64(n)) % np.uint64(n_groups) for n, m in enumerate(TABLES)]).astype(np.int32)
        n, sim = np.repeat(np.arange(len(TABLES), dtype=np.uint8), len(sim)), np.tile(sim, len(TABLES))
        order = np.argsort(g, kind="stable")
        g, n, sim = g[order], n[order], sim[order]
        first = np.flatnonzero(np.diff(g, prepend=-1)).tolist()
        cut = list(zip(first, [*first[1:], len(g)]))
        return pa.RecordBatch.from_pydict({"g": pa.array(g[first]), "n": pa.array([squeeze(n[lo:hi]) for lo, hi in cut], pa.binary()),
                                           "sim": pa.array([squeeze(sim[lo:hi]) for lo, hi in cut], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b.column("sim").to_numpy().view(np.uint64))
            size += len(held[-1])
            if size >= DEALT:
                yield rows(np.concatenate(held))
                held, size = [], 0
                release()
        if size:
            yield rows(np.concatenate(held))

    return run


def bucketed(rows: DataFrame, n_groups: int) -> DataFrame:
    masks = F.array(*[F.lit(_signed(m)) for m in TABLES])
    return rows.withColumn("g", F.pmod(F.xxhash64("n", F.col("sim").bitwiseAND(F.get(masks, F.col("n")))), F.lit(n_groups)).cast("int"))


def near_in_buckets(n: np.ndarray, sim: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius of one bucket, each in the first table that shows it; rows sorted by (n, key)."""
    masks = np.array(TABLES, np.uint64)
    key = sim & masks[n]
    for d in range(1, len(n)):
        a = np.flatnonzero((key[d:] == key[:-d]) & (n[d:] == n[:-d]))
        if not len(a):
            return
        apart = sim[a] ^ sim[a + d]
        near = np.bitwise_count(apart) <= RADIUS
        a, apart = a[near], apart[near]
        first = ((apart[:, None] & masks[None, :]) == 0).argmax(axis=1) == n[a]
        yield a[first], a[first] + d


def _by_bucket(n: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((sim & np.array(TABLES, np.uint64)[n], n))
    return order, n[order], sim[order]


def _partnered(t: pa.Table) -> pa.Table:
    """(sim, n) of fingerprints with a partner in their bucket."""
    n, sim = (np.concatenate([unsqueeze(x.as_py(), kind) for x in t.column(c)]) for c, kind in (("n", np.uint8), ("sim", np.uint64)))
    order, n, sim = _by_bucket(n.astype(np.int32), sim)
    has = np.zeros(len(order), bool)
    for a, b in near_in_buckets(n, sim):
        has[a] = has[b] = True
    return pa.table({"sim": pa.array(sim[has].view(np.int64)), "n": pa.array(n[has])})


def edit_distance(a: str, b: str, limit: float = math.inf) -> float:
    """Levenshtein distance by bit vectors (one Python integer a column); infinite once it must exceed ``limit``."""
    start = 0
    for x, y in zip(a, b):
        if x != y:
            break
        start += 1
    a, b = a[start:], b[start:]
    while a and b and a[-1] == b[-1]:
        end = max(1, len(a) // 2)
        while a[-end:] != b[-end:]:
            end //= 2
        a, b = a[:-end], b[:-end]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    limit += len(b)  # each column takes one off the score at most
    for c in b:
        eq = at.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        right = down | ~(diag | up) & full
        left = up & diag
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        limit -= 1
        if score > limit:
            return math.inf
        right = right << 1 | 1
        up = (left << 1 | ~(diag | right)) & full
        down = right & diag & full
    return score


def similar(a: str, b: str) -> bool:
    limit = (1 - SIMILARITY) * max(len(a), len(b)) + 1e-9
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(v), len(w)) for v, w in zip(x, y) if v != w) <= limit:
        return True  # replacing the words that differ is one way to edit
    return edit_distance(a, b, limit) <= limit


def _verified(t: pa.Table) -> pa.Table:
    """Star edges of the verified links; a pair already in one local group needs no check."""
    order, n, sim = _by_bucket(t.column("n").to_numpy(), t.column("sim").to_numpy().view(np.uint64))
    at = pa.array(order)
    ids, norm = t.column("h1").to_numpy()[order], t.column("norm").take(at).to_pylist()
    size = t.column("size").to_numpy()[order]
    up = np.arange(len(order))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in near_in_buckets(n, sim):
        fit = np.minimum(size[a], size[b]) >= SIMILARITY * np.maximum(size[a], size[b]) - 1e-9
        for i, j in zip(a[fit].tolist(), b[fit].tolist()):
            x, y = root(i), root(j)
            if x != y and similar(norm[i], norm[j]):
                up[max(x, y)] = min(x, y)
    top = np.array([root(i) for i in range(len(up))], np.int64)
    star = top != np.arange(len(up))
    return pa.table({"a": pa.array(ids[star]), "b": pa.array(ids[top[star]])})


def groups(rows: int) -> int:
    """Groups of buckets for tasks: about 65,536 rows each."""
    return rows // 65536 + 1


def links(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """Star edges (a, b) over line hashes: their components are those of all verified links."""
    spark = docs.sparkSession
    sims = materialize(lines.groupBy("sim").agg(F.count("*").alias("lines")), "line-sims")
    n_groups = groups(len(TABLES) * sims.count())
    dealt = sims.select("sim").mapInArrow(_deal(n_groups), "g int, n binary, sim binary")
    partnered = dealt.groupBy("g").applyInArrow(_partnered, "sim long, n int")
    same = sims.where("lines > 1").select("sim", F.lit(0).alias("n"))  # equal fingerprints meet in the first table
    partnered = materialize(partnered.unionByName(same).distinct(), "line-near")
    # the wanted lines' texts, from their first occurrence
    near = materialize(lines.join(partnered, "sim").select("h1", "sim", "size", "n", "doc_id", "tkey", "line"), "line-wanted")
    wanted = near.groupBy(F.col("doc_id").alias("wd"), F.col("tkey").alias("wt")).agg(F.collect_set("line").alias("lines"))
    # only documents that may have such a line are packed and shuffled
    some = spark.sparkContext.broadcast(key_filter(near.select("tkey").distinct(), ["tkey"]).tobytes())
    texts = docs.mapInArrow(_among(some), "doc_id long, packed binary, tkey long").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("wd")) & (F.col("tkey") == F.col("wt"))).dropDuplicates(["doc_id", "tkey"]).select(
        "doc_id", "tkey", "packed", "lines").mapInArrow(_texts, "doc_id long, tkey long, line int, norm string")
    texts = texts.select(F.col("doc_id").alias("xd"), F.col("tkey").alias("xt"), F.col("line").alias("xl"), "norm")
    full = near.join(texts, F.col("doc_id").eqNullSafe(F.col("xd")) & (F.col("tkey") == F.col("xt")) & (F.col("line") == F.col("xl")))
    full = bucketed(full.select("h1", "sim", "size", "n", "norm"), n_groups)
    return full.groupBy("g").applyInArrow(_verified, "a long, b long")


def _with(bits, key: str):
    """Rows whose ``key`` may be in a filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            yield b.filter(pa.array(in_filter(held, b.column(key).to_numpy()[:, None])))

    return run


def line_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, line, h1, h2, root, keep) for each line with a letter, mark or number that occurs again or is linked; the others
    all stay.  ``docs`` has doc_id, tkey, text."""
    lines = materialize(docs.where("text is not null").select("doc_id", "tkey", "text").mapInArrow(
        _lines, "doc_id long, tkey long, line int, h1 long, h2 long, sim long, size int"), "lines", "zstd")
    place = F.struct("doc_id", "tkey", "line")
    distinct = lines.groupBy("h1", "h2").agg(F.min(place).alias("p"), F.first("sim").alias("sim"), F.first("size").alias("size"),
                                             F.count("*").alias("times"))
    distinct = materialize(distinct.select("h1", "h2", "sim", "size", "times", "p.*"), "line-distinct", "zstd")
    stars = materialize(components(links(distinct, docs), "line-stars"), "line-roots")
    linked = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    # a line without links is its own group: (h1, h2); others go by their root
    group = distinct.join(linked, F.col("h1") == F.col("node"), "left").where("root IS NOT NULL OR times > 1").select(
        "h1", "h2", F.coalesce("root", "h1").alias("root"), place.alias("place"), F.when(F.col("root").isNull(), F.col("h2")).alias("alone"))
    group = materialize(group, "line-several")
    some = docs.sparkSession.sparkContext.broadcast(key_filter(group, ["h1"]).tobytes())
    first = group.groupBy("root", "alone").agg(F.min("place").alias("first"))
    group = group.join(first.select(F.col("root").alias("fr"), F.col("alone").alias("fa"), "first"),
                       (F.col("root") == F.col("fr")) & F.col("alone").eqNullSafe(F.col("fa"))).select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"), "root", "first")
    again = lines.select("doc_id", "tkey", "line", "h1", "h2").mapInArrow(_with(some, "h1"), "doc_id long, tkey long, line int, h1 long, h2 long")
    out = again.join(group, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    keep = F.struct("doc_id", "tkey", "line").eqNullSafe(F.col("first"))
    return out.select("doc_id", "tkey", "line", "h1", "h2", "root", keep.alias("keep"))


def _apply(texts):
    """Lines kept of each row; ``texts`` gives a batch's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, kept = [], [], []
            for t, gone in zip(texts(b).to_pylist(), b.column("gone").to_pylist()):
                lines = [] if t is None else t.split("\n")
                out = set(gone or ())
                total.append(len(lines))
                removed.append(len(out))
                kept.append(t or "" if not out else "\n".join(x for i, x in enumerate(lines) if i not in out))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_lines", "n_removed", "kept"])
            release()

    return run


def dedup_lines(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, kept) for every row: kept lines joined by one newline."""
    spark = docs.sparkSession
    bounded_batches(spark)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tkey"))
    gone = materialize(line_groups(d).where("not keep").groupBy(F.col("doc_id").alias("gd"), F.col("tkey").alias("gt")).agg(
        F.collect_set("line").alias("gone")), "line-gone")
    # documents that certainly lose nothing go straight through, the others meet their lines
    some = spark.sparkContext.broadcast(key_filter(gone.select(F.col("gt").alias("tkey")).distinct(), ["tkey"]).tobytes())
    schema = "doc_id long, n_lines long, n_removed long, kept string"
    clean = d.mapInArrow(_among(some, False), "doc_id long, text string, tkey long").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("gone")).mapInArrow(_apply(lambda b: b.column("text")), schema)
    out = d.mapInArrow(_among(some), "doc_id long, packed binary, tkey long").join(
        gone, F.col("doc_id").eqNullSafe(F.col("gd")) & (F.col("tkey") == F.col("gt")), "left")
    out = out.select("doc_id", "packed", "gone").mapInArrow(_apply(lambda b: unpack(b.column("packed"))), schema)
    return out.unionAll(clean)
