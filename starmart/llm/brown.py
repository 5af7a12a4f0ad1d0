"""LM scoring with a Brown class-based bigram model.

``P(w | previous) = P(class(w) | class(previous)) * P(w | class(w))``, over words
and one end token after each document.  What is learnt, over all training
documents: the count of every word, classes, class transitions, emissions.

Documents are coded in blocks of about 8 MB of text: word codes, and the
block's own vocabulary as (64-bit word hash, training count), sorted by hash.
Spark sums the counts of every word over the blocks: each block cuts its vocabulary
at the bounds of ``buckets`` hash ranges, a range meets in one task and gives each
block the sums of its words back, in the block's order.  The units that are clustered are words
with at least ``MIN_COUNT`` training tokens and, for rarer words, seen or not,
``ENDINGS`` groups by a hash of their last two characters.  Hash, count and class
of the units (17 bytes each) are broadcast; context counts are kept sparse, in
ranges whose number grows with the vocabulary.

Exchange clustering: units start in classes by frequency rank.  In a sweep every
block counts, for each unit, the classes of the tokens before and after it;
counts are merged per task and then per range of units; each unit moves to the
class under which its contexts are likeliest, given the current class bigrams
(its own counts taken out of the class that it is in).  After the first sweep
only every other unit moves, so that two do not swap places for ever.

Smoothing: transitions are interpolated with the class unigram (``PRIOR``
pseudo-counts); units have ``ALPHA`` pseudo-counts in their class; rare words
within their ending use absolute discounting whose freed mass is shared by as
many unseen words as the ending has seen ones (and one more).

Scoring co-groups each block with the counts of its words: one task holds one
block, whatever the corpus.

Defined cases: a null or empty text is the end token alone; ties in likelihood
go to the lower class; a null doc_id counts as training; without any training
document all words are unseen; repeated rows are scored alike and each counts;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import (bounded_batches, hash_words, materialize, release, split_words, squeeze, text_slices,
                                 unsqueeze)

CLASSES = 64
ENDINGS = 1024
MIN_COUNT = 8
SWEEPS = 4
PRIOR = 64.0
ALPHA = 0.1
DISCOUNT = 0.5
BLOCK_BYTES = 8 << 20
RANGE_UNITS = 16384  # units of a range; a range is one task
BUCKET_WORDS = 1 << 20  # words of all blocks in one range of hashes; a range is one task
PENDING = 1 << 20  # context counts held before they are summed up
#: the end token's class, after those of the units
END = CLASSES
CONTEXTS = END + 1


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 7."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, doc_id, held, ends, codes, hashes, counts, ending) of about BLOCK_BYTES of text each; lists as bytes."""
    held: list[tuple[pa.Array, pa.Array]] = []
    size = 0
    block = TaskContext.get().partitionId() << 32  # the task's number and a running one

    def close() -> pa.RecordBatch:
        ids, text = pa.concat_arrays([i for i, _ in held]), pa.concat_arrays([t for _, t in held])
        codes, starts, words = split_words(text, lower=True)
        h = hash_words(words)
        out = np.fromiter((held_out(x) for x in ids.to_pylist()), bool, len(ids))
        train = np.repeat(~out, np.diff(starts))
        order = np.argsort(h)
        rank = np.empty(len(h), np.int32)
        rank[order] = np.arange(len(h), dtype=np.int32)
        codes = rank[codes] if len(codes) else np.empty(0, np.int32)
        count = np.bincount(codes[train], minlength=len(h)).astype(np.int64)
        tail = hash_words(pc.utf8_slice_codeunits(words, -2), 11)[order]
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int64()), "doc_id": pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            "held": pa.array([squeeze(out)], pa.binary()), "ends": pa.array([squeeze(starts[1:])], pa.binary()),
            "codes": pa.array([squeeze(codes.astype(np.int32))], pa.binary()), "hashes": pa.array([h[order].tobytes()], pa.binary()),
            "counts": pa.array([squeeze(count)], pa.binary()),
            "ending": pa.array([squeeze((tail % np.uint64(ENDINGS)).astype(np.int32))], pa.binary()),
            "tokens": pa.array([int((~out).sum() + train.sum())], pa.int64()), "words": pa.array([len(h)], pa.int64())})

    for b in batches:
        text = b.column("text")
        for lo, hi in text_slices(text, BLOCK_BYTES // 4):
            held.append((b.column("doc_id").slice(lo, hi - lo), text.slice(lo, hi - lo)))
            size += pc.sum(pc.fill_null(pc.binary_length(held[-1][1]), 0)).as_py() or 0
            if size >= BLOCK_BYTES:
                yield close()
                held, size, block = [], 0, block + 1
                release()
    if held:
        yield close()


BLOCK_SCHEMA = ("block long, doc_id array<long>, held binary, ends binary, codes binary, hashes binary, counts binary, "
                "ending binary, tokens long, words long")


def _numbers(row: pa.RecordBatch, name: str, kind: type, i: int = 0) -> np.ndarray:
    raw = row.column(name)[i].as_py()
    return np.frombuffer(raw, kind) if name == "hashes" else unsqueeze(raw, kind)


def _vocabulary(buckets: int):
    """(bucket, block, hashes, counts, ending): each block's vocabulary, cut at the bounds of equal ranges of hashes."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                h, n, ending = (_numbers(b, c, t, i) for c, t in (("hashes", np.uint64), ("counts", np.int64), ("ending", np.int32)))
                cut = [0, *np.searchsorted(h, bounds).tolist(), len(h)]
                parts = [(k, slice(lo, hi)) for k, (lo, hi) in enumerate(zip(cut, cut[1:])) if lo < hi]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([k for k, _ in parts], pa.int32()), "block": pa.array([b.column("block")[i].as_py()] * len(parts), pa.int64()),
                    "hashes": pa.array([h[x].tobytes() for _, x in parts], pa.binary()),
                    "counts": pa.array([squeeze(n[x]) for _, x in parts], pa.binary()),
                    "ending": pa.array([squeeze(ending[x]) for _, x in parts], pa.binary())})

    return run


def _summed(t: pa.Table) -> pa.Table:
    """One bucket: a row for each block with the training counts of its words over all blocks (``c``), and one without a block:
    words of at least MIN_COUNT (``hashes``, ``c``), number (``seen``) and tokens (``mass``) of the rarer ones by ending."""
    hashes = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("hashes")]
    n, ending = (np.concatenate([unsqueeze(x.as_py(), kind) for x in t.column(c)]) for c, kind in (("counts", np.int64), ("ending", np.int32)))
    h, first, row = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.zeros(len(h), np.int64)
    np.add.at(total, row, n)
    ending, often, rare = ending[first], total >= MIN_COUNT, (total > 0) & (total < MIN_COUNT)
    seen, mass = np.bincount(ending[rare], minlength=ENDINGS), np.zeros(ENDINGS, np.int64)
    np.add.at(mass, ending[rare], total[rare])
    each = np.split(total[row], np.cumsum([len(x) for x in hashes])[:-1])
    none = [None] * len(each)
    return pa.table({"bucket": pa.array([t.column("bucket")[0].as_py()] * (len(each) + 1), pa.int32()),
                     "block": pa.array([*t.column("block").to_pylist(), None], pa.int64()),
                     "c": pa.array([*map(squeeze, each), squeeze(total[often])], pa.binary()),
                     "hashes": pa.array([*none, h[often].tobytes()], pa.binary()), "seen": pa.array([*none, squeeze(seen)], pa.binary()),
                     "mass": pa.array([*none, squeeze(mass)], pa.binary())})


@dataclass
class Units:
    """Clustered words by sorted hash, then the endings; counts and classes of all of them."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray

    def find(self, h: np.ndarray, ending: np.ndarray) -> np.ndarray:
        """Unit of each word: its own, or its ending's."""
        rare = len(self.hashes) + ending
        if not len(self.hashes):
            return rare
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, rare)


def _streams(row: pa.RecordBatch, i: int, of: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one block whose words have units ``of``: (unit or -1, class) of every token with the end tokens put in, ends' places, training mask."""
    codes, ends = _numbers(row, "codes", np.int32, i), _numbers(row, "ends", np.int64, i)
    last = ends + np.arange(len(ends))
    total = len(codes) + len(ends)
    real = np.ones(total, bool)
    real[last] = False
    unit, klass = np.full(total, -1, np.int32), np.full(total, END, np.int32)
    unit[real] = of.astype(np.int32)[codes]
    klass[real] = classes[unit[real]]
    train = np.repeat(~_numbers(row, "held", bool, i), np.diff(np.concatenate(([-1], last))))
    return unit, klass, last, train


class _Sparse:
    """Counts by place, summed up as they come: as large as the places seen, not as all units by all classes."""

    def __init__(self):
        self.at, self.n, self.new, self.size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, at: np.ndarray) -> None:
        self.new.append(np.unique(at, return_counts=True))
        self.size += len(self.new[-1][0])
        if self.size > PENDING:
            self.merge()

    def merge(self) -> None:
        at, n = (np.concatenate(x) for x in zip((self.at, self.n), *self.new))
        order = np.argsort(at, kind="stable")
        at, n = at[order], n[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        self.at, self.n = at[first], np.add.reduceat(n, first) if len(first) else n
        self.new, self.size = [], 0


def edges(units: int) -> list[int]:
    """Bounds of the ranges of units; their number grows with the vocabulary."""
    ranges = max(16, -(-units // RANGE_UNITS))
    return [units * k // ranges for k in range(ranges + 1)]


def _count_contexts(sent, contexts: bool):
    """Per task: the class bigrams and, if wanted, sparse (range, left and right context counts of units)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = sent.value
        after, before, pairs = _Sparse(), _Sparse(), np.zeros(CONTEXTS * CONTEXTS, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                of = units.find(_numbers(b, "hashes", np.uint64, i), _numbers(b, "ending", np.int32, i))
                unit, klass, _, train = _streams(b, i, of, units.classes)
                prev = np.concatenate(([END], klass[:-1]))
                pairs += np.bincount(prev[train] * CONTEXTS + klass[train], minlength=len(pairs))
                if contexts:
                    real = train & (unit >= 0)
                    at = unit[real].astype(np.int64) * CONTEXTS
                    after.add(at + np.concatenate((klass[1:], [END]))[real])
                    before.add(at + prev[real])
                del unit, klass, train, prev, of
                release()
        at = np.flatnonzero(pairs)
        rows = [(-1, 0, at.astype(np.int64), pairs[at])]
        edge = np.array(edges(len(units.classes)), np.int64) * CONTEXTS
        for side, held in enumerate((after, before)):
            held.merge()
            cut = np.searchsorted(held.at, edge)
            for k in np.flatnonzero(np.diff(cut)).tolist():
                rows.append((k, side, held.at[cut[k]:cut[k + 1]] - edge[k], held.n[cut[k]:cut[k + 1]]))
        for k, side, at, n in rows:
            gaps = np.diff(at, prepend=0)
            yield pa.RecordBatch.from_pydict({"range": pa.array([k], pa.int32()), "side": pa.array([side], pa.int32()),
                                              "at": pa.array([squeeze(gaps.astype(np.int32))], pa.binary()),
                                              "n": pa.array([squeeze(n.astype(np.int64))], pa.binary())})

    return run


def class_bigrams(counted: DataFrame) -> np.ndarray:
    """CONTEXTS x CONTEXTS counts: one small row for each task."""
    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(CONTEXTS * CONTEXTS, np.int64)
        for at, n in zip(t.column("at"), t.column("n")):
            total[np.cumsum(unsqueeze(at.as_py(), np.int32))] += unsqueeze(n.as_py(), np.int64)
        return pa.table({"n": pa.array([total.tobytes()], pa.binary())})

    got = counted.where("range = -1").groupBy("range").applyInArrow(add, "n binary").collect()
    flat = np.frombuffer(got[0][0], np.int64) if got else np.zeros(CONTEXTS * CONTEXTS, np.int64)
    return flat.reshape(CONTEXTS, CONTEXTS)


def best_classes(after: np.ndarray, before: np.ndarray, now: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """For each unit (row of context counts) the class that makes its contexts likeliest; ties: the lower."""
    soft = bigrams + 0.1
    total = np.maximum(bigrams.sum(axis=1), 1.0) + 0.1 * CONTEXTS
    follow = np.log(soft[:CLASSES] / total[:CLASSES, None])  # class x next context
    lead = np.log(soft[:, :CLASSES] / total[None, :CLASSES])  # previous context x class, per occurrence of the class
    gain = after @ follow.T + before @ lead
    # leave one out: a unit's own counts do not speak for the class that it is in
    own, n = np.arange(len(now)), after.sum(axis=1)
    rest = np.maximum(total[now] - n, 0.1 * CONTEXTS)
    stay = ((after * np.log(np.maximum(soft[now] - after, 0.1) / rest[:, None])).sum(axis=1)
            + (before * np.log(np.maximum(soft[:, now].T - before, 0.1) / rest[:, None])).sum(axis=1))
    gain[own, now] = stay
    return gain.argmax(axis=1)


def cluster(spark: SparkSession, blocks: DataFrame, hashes: np.ndarray, counts: np.ndarray, sweeps: int = SWEEPS) -> tuple[Units, np.ndarray]:
    """Classes of the units, and the class bigrams under them."""
    classes = np.empty(len(counts), np.uint8)
    classes[np.argsort(-counts, kind="stable")] = np.arange(len(counts)) % CLASSES
    edge = edges(len(counts))
    for sweep in count():
        units = Units(hashes, counts, classes)
        sent = spark.sparkContext.broadcast(units)
        counted = materialize(blocks.select("held", "ends", "codes", "hashes", "ending").mapInArrow(
            _count_contexts(sent, sweep < sweeps), "range int, side int, at binary, n binary"), "contexts")
        bigrams = class_bigrams(counted)
        if sweep == sweeps:
            return units, bigrams

        def exchange(t: pa.Table) -> pa.Table:
            now = sent.value.classes
            k = t.column("range")[0].as_py()
            n = edge[k + 1] - edge[k]
            both = np.zeros((2, n * CONTEXTS), np.int64)
            for side, at, c in zip(t.column("side").to_pylist(), t.column("at"), t.column("n")):
                both[side][np.cumsum(unsqueeze(at.as_py(), np.int32))] += unsqueeze(c.as_py(), np.int64)
            out = np.empty(n, np.int64)
            for i in range(0, n, 4096):
                a, b = (x.reshape(n, CONTEXTS)[i:i + 4096].astype(np.float64) for x in both)
                out[i:i + 4096] = best_classes(a, b, now[edge[k] + i:edge[k] + min(i + 4096, n)], bigrams)
            return pa.table({"range": pa.array([k], pa.int32()), "classes": pa.array([out.astype(np.uint8).tobytes()], pa.binary())})

        moved = counted.where("range >= 0").groupBy("range").applyInArrow(exchange, "range int, classes binary").collect()
        wanted = classes.copy()
        for k, raw in moved:
            wanted[edge[k]:edge[k + 1]] = np.frombuffer(raw, np.uint8)
        turn = (np.arange(len(counts)) % 2 == sweep % 2) | (sweep == 0)
        classes = np.where(turn, wanted, classes)


@dataclass
class Model:
    """What scoring needs besides the counts of a block's words."""

    units: Units
    transition: np.ndarray  # log10 P(class | previous class)
    emission: np.ndarray  # P(unit | its class)
    seen: np.ndarray  # distinct training words of each ending
    tokens: int  # N
    words: int  # V
    ends: int  # training documents


def transitions(bigrams: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    unigram = (bigrams.sum(axis=0) + 0.5) / (bigrams.sum() + 0.5 * CONTEXTS)
    return np.log10((bigrams + prior * unigram[None, :]) / (bigrams.sum(axis=1, keepdims=True) + prior))


def unit_emissions(units: Units, bigrams: np.ndarray) -> np.ndarray:
    """P(unit | its class)."""
    size = np.bincount(units.classes, minlength=CONTEXTS)
    return (units.counts + ALPHA) / (bigrams.sum(axis=0) + ALPHA * size)[units.classes]


def emissions(model: Model, unit: np.ndarray, total: np.ndarray) -> np.ndarray:
    """log10 P(word | class) of a block's words, by unit and training count."""
    p = model.emission[unit]
    rare = unit >= len(model.units.hashes)
    ending = np.where(rare, unit - len(model.units.hashes), 0)
    mass, seen = model.units.counts[unit].astype(float), model.seen[ending].astype(float)
    within = np.where(total > 0, total - DISCOUNT, DISCOUNT * seen / (seen + 1))
    within = np.where(mass > 0, within / np.maximum(mass, 1), 1.0)
    return np.log10(np.where(rare, p * within, p))


def _score(model):
    kind = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                      ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(blocks: pa.Table, words: pa.Table) -> pa.Table:
        m, out = model.value, []
        parts = sorted(zip(words.column("bucket").to_pylist(), words.column("c").to_pylist()))  # ranges in order: as the block's codes go
        total = np.concatenate([np.empty(0, np.int64), *[unsqueeze(c, np.int64) for _, c in parts]])
        block = blocks.combine_chunks().to_batches()[0]
        of = m.units.find(_numbers(block, "hashes", np.uint64), _numbers(block, "ending", np.int32))
        emit, base = emissions(m, of, total), np.log10((total + 1) / (m.tokens + m.words + 1))
        end = math.log10((m.ends + 1) / (m.tokens + m.words + 1))
        for row in blocks.to_batches():
            for i in range(row.num_rows):
                _, klass, last, _ = _streams(row, i, of, m.units.classes)
                codes = _numbers(row, "codes", np.int32, i)
                real = np.ones(len(klass), bool)
                real[last] = False
                first = np.concatenate(([0], last[:-1] + 1))

                def sums(each: np.ndarray, words: np.ndarray) -> pa.Array:
                    each[real] += words[codes]
                    return pa.array(np.add.reduceat(each, first))

                out.append(pa.RecordBatch.from_arrays([
                    pa.array(row.column("doc_id")[i].as_py(), pa.int64()), pa.array(_numbers(row, "held", bool, i)), pa.array(last - first + 1),
                    sums((~real & (m.ends > 0)).astype(np.int64), (total > 0).astype(np.int64)), pa.array(np.full(len(last), m.tokens, np.int64)),
                    sums(np.where(real, 0.0, end), base),
                    sums(m.transition[np.concatenate(([END], klass[:-1])), klass], emit)], schema=kind))
        return pa.Table.from_batches(out, kind)

    return run


def score_documents(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = materialize(d.mapInArrow(_blocks, BLOCK_SCHEMA), "blocks")
    size = blocks.agg(F.sum("tokens"), F.sum("words")).first()
    tokens = int(size[0] or 0)
    vocab = blocks.select("block", "hashes", "counts", "ending").mapInArrow(
        _vocabulary(int(size[1] or 0) // BUCKET_WORDS + 1), "bucket int, block long, hashes binary, counts binary, ending binary")
    words = materialize(vocab.groupBy("bucket").applyInArrow(
        _summed, "bucket int, block long, c binary, hashes binary, seen binary, mass binary"), "words")
    totals = words.where("block IS NULL").select("hashes", "c", "seen", "mass").collect()  # one row a bucket
    h = np.frombuffer(b"".join(r.hashes for r in totals), np.uint64)
    c = np.concatenate([np.empty(0, np.int64), *[unsqueeze(r.c, np.int64) for r in totals]])
    order = np.argsort(h)
    seen, mass = (sum((unsqueeze(r[name], np.int64) for r in totals), np.zeros(ENDINGS, np.int64)) for name in ("seen", "mass"))
    units, bigrams = cluster(spark, blocks, h[order], np.concatenate((c[order], mass)), sweeps)
    ends = tokens - int(c.sum() + mass.sum())
    model = spark.sparkContext.broadcast(Model(units, transitions(bigrams), unit_emissions(units, bigrams), seen, tokens,
                                               len(h) + int(seen.sum()) + (ends > 0), ends))
    coded = blocks.select("block", "doc_id", "held", "ends", "codes", "hashes", "ending")
    counts = words.where("block IS NOT NULL").select("block", "bucket", "c")
    return coded.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        _score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
