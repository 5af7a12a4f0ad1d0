"""Mixture-controlled packing: deficit round-robin over source queues into windows of fixed length.

1. Every document is encoded once, where it is read; its ids and its place in
   the queue of its source (a running count in the task, plus the sum of the
   tasks before, from the one-row-per-task-and-source table) are written.
2. Queues advance side by side: token ``x`` of a queue of weight ``w`` is due at
   ``(2x + 1) / 2w``.  Ordered by due time, ties by queue, tokens have exact
   ranks (integer arithmetic over the table of queues), and rank ``//`` shard
   size is the token's shard: every shard is ``SHARD_WINDOWS`` whole windows
   and takes from each queue what its weight is due, to the token.  No task
   has to know what another one served.
3. A shard is one task's group of bounded size.  Its deficits start from what
   the queues are ahead or behind at its first token (the carry between
   partitions).  In each window every queue gets its share of the window on its
   deficit and serves that many tokens, visited in turn from where the last window
   stopped; a document whose rest is within ``SLACK`` tokens is finished on
   debt.  What a queue is owed or owes at the end of a window carries over.

Weights default to the queues' own sizes, so that all queues end together and
every window holds the table's own mix; other weights run until a queue is
empty, the rest then share the windows by their weights.  Only the table's very
last window can be short.  At most ``MAX_QUEUES`` queues are kept (a window
cannot hold a share of more); with more sources, queues are hash groups of them.

Defined cases: a null or empty text is the end id alone; the null source is a
source of its own; repeated rows and null doc_ids are documents like others; a
document of any length is cut where windows end; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, materialize, text_slices
from starmart.llm.token_store import BATCH_BYTES, encoder

END_ID = 2
WINDOW = 4096
SHARD_WINDOWS = 256
SLACK = 64
MAX_QUEUES = 1024

ENCODED = "doc_id long, source string, part int, place long, n_tokens long, ids binary"
CUT = "shard long, queue int, place long, doc_id long, start long, doc_tokens long, ids binary"
PIECES = "doc_id long, source_queue int, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _encode(path: str, end_id: int):
    kind = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("place", pa.int64()),
                      ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width = np.dtype("<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        served: dict[str | None, int] = {}
        for b in batches:
            for lo, hi in text_slices(b.column("text"), BATCH_BYTES):
                ids, count = enc.texts(b.column("text").slice(lo, hi - lo), False, end_id)
                raw = ids.astype(width).tobytes()
                ends = np.concatenate(([0], np.cumsum(count))) * width.itemsize
                sources = b.column("source").slice(lo, hi - lo)
                place = np.empty(len(count), np.int64)
                for i, (s, n) in enumerate(zip(sources.to_pylist(), count.tolist())):
                    place[i] = served.get(s, 0)
                    served[s] = served.get(s, 0) + n
                lists = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), sources, b.column("part").slice(lo, hi - lo),
                                                  pa.array(place), pa.array(count), lists], schema=kind)

    return run


def rank(queue: int, x: int, size: list[int], weight: list[int]) -> int:
    """How many tokens of all queues are due before token ``x`` of ``queue``."""
    mine, due, n = weight[queue], 2 * x + 1, 0
    for r, (s, w) in enumerate(zip(size, weight)):
        if r == queue:
            n += x
        else:  # tokens y of r with (2y + 1) / w before due / mine; at equal times the lower queue goes first
            n += min(s, max(0, (due * w - mine - (r > queue)) // (2 * mine) + 1))
    return n


class Shards:
    """Shards of tokens; exact ranks are only worked out where an estimate lies next to a shard's edge."""

    def __init__(self, size: list[int], weight: list[int], tokens: int):
        self.size, self.weight, self.tokens = size, weight, tokens
        self.even, self.total = size == weight, sum(size)

    def of(self, queue: int, x: int) -> int:
        if self.even:
            about, spread = (2 * x + 1) * self.total // (2 * self.size[queue]), len(self.size) + 2
            k = about // self.tokens
            if k * self.tokens + spread <= about < (k + 1) * self.tokens - spread:
                return k
        return rank(queue, x, self.size, self.weight) // self.tokens

    def cuts(self, queue: int, lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(shard, from, to) of the tokens ``lo:hi`` of a queue."""
        out, last = [], self.of(queue, hi - 1)
        while True:
            k = self.of(queue, lo)
            if k == last:
                return [*out, (k, lo, hi)]
            a, b = lo, hi - 1  # the first token past shard k
            while a + 1 < b:
                m = (a + b) // 2
                a, b = (m, b) if self.of(queue, m) == k else (a, m)
            out.append((k, lo, b))
            lo = b


def _cut(size: list[int], weight: list[int], tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = Shards(size, weight, tokens)
        names = ["shard", "queue", "place", "doc_id", "start", "doc_tokens", "ids"]
        for b in batches:
            rows, of = [], []
            ids = b.column("ids")
            columns = (b.column(c).to_pylist() for c in ("queue", "place", "n_tokens"))
            for i, (q, at, n) in enumerate(zip(*columns)):
                for k, lo, hi in shards.cuts(q, at, at + n):
                    rows.append((k, q, lo, lo - at, n, hi - lo))
                    of.append(i)
            if not rows:
                continue
            k, q, lo, start, n, length = np.array(rows, np.int64).T
            raw = ids.take(pa.array(of))
            if len(rows) > b.num_rows:  # some document lies in several shards
                parts = []
                for x, s, m, whole in zip(raw, start.tolist(), length.tolist(), n.tolist()):
                    x = x.as_buffer()
                    wide = x.size // whole
                    parts.append(x.slice(s * wide, m * wide).to_pybytes())
                raw = pa.array(parts, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(q.astype(np.int32)), pa.array(lo), b.column("doc_id").take(pa.array(of)),
                                              pa.array(start), pa.array(n), raw], names=names)

    return run


def round_robin(queues: list[int], lengths: list[list[int]], weights: list[float], debts: list[float],
                window: int, slack: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Deficit round-robin over the queues of one shard.

    ``lengths[i]`` are the pieces of queue ``i`` in order, ``debts[i]`` its deficit at the start.
    Yields (window, offset, i, piece, from, length).
    """
    deficit = list(debts)
    left = [sum(x) for x in lengths]
    piece, inside = [0] * len(queues), [0] * len(queues)
    turn, number = 0, 0
    live = [i for i in range(len(queues)) if left[i]]
    while live:
        share = window / sum(weights[i] for i in live)
        for i in live:
            deficit[i] += share * weights[i]
        order = [i for i in live if i >= turn] + [i for i in live if i < turn]
        room, take = window, {}
        for i in order:
            n = min(max(int(deficit[i]), 0), left[i], room)
            if n:  # finish a document whose rest is short, on debt
                p, end = piece[i], -inside[i]
                while end < n:
                    end += lengths[i][p]
                    p += 1
                if n < end <= min(n + slack, room):
                    n = end
            take[i] = n
            room -= n
            if not room:
                turn = i + 1
                break
        if room:  # fractions and empty queues leave room: to those who are owed most
            for i in sorted(order, key=lambda i: take[i] - deficit[i]):
                more = min(left[i] - take[i], max(1, int(deficit[i] - take[i])), room)
                take[i] += more
                room -= more
            for i in order:
                more = min(left[i] - take[i], room)
                take[i] += more
                room -= more
        offset = 0
        for i in order:
            n = take.get(i, 0)
            deficit[i] -= n
            left[i] -= n
            while n:
                m = min(n, lengths[i][piece[i]] - inside[i])
                yield number, offset, i, piece[i], inside[i], m
                offset += m
                n -= m
                inside[i] += m
                if inside[i] == lengths[i][piece[i]]:
                    piece[i], inside[i] = piece[i] + 1, 0
        number += 1
        live = [i for i in live if left[i]]


def _serve(weight: list[int], width: str, window: int, shard_windows: int, slack: int):
    kind = pa.schema([("doc_id", pa.int64()), ("source_queue", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                      ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        queue, place = t.column("queue").to_numpy(), t.column("place").to_numpy()
        ids = t.column("ids").chunk(0) if t.num_rows else pa.array([], pa.binary())
        length = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64) // np.dtype(width).itemsize
        begin, length = length[:-1], np.diff(length)
        order = np.lexsort((t.column("doc_id").to_numpy(), place, queue))
        first = np.concatenate(([0], np.flatnonzero(np.diff(queue[order])) + 1, [len(order)]))
        members = [order[a:b] for a, b in zip(first[:-1], first[1:])]
        queues = [int(queue[m[0]]) for m in members]
        w = [float(weight[q]) for q in queues]
        lead = [int(place[m[0]]) for m in members]
        now = min((x + 0.5) / v for x, v in zip(lead, w))
        debts = [now * v - x for x, v in zip(lead, w)]
        got = list(round_robin(queues, [length[m].tolist() for m in members], w, debts, window, slack))
        number, offset, i, p, at, n = np.array(got, np.int64).T
        row = np.concatenate(members)[first[i] + p]
        flat = np.frombuffer(ids.buffers()[2], width).astype("<u4")
        total = np.cumsum(n)
        out = flat[np.arange(total[-1]) + np.repeat(begin[row] + at - (total - n), n)]
        ends = np.concatenate(([0], total)) * 4
        packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out.tobytes())])
        shard = t.column("shard")[0].as_py()
        take = pa.array(row)
        return pa.table([t.column("doc_id").take(take), pa.array(queue[row]), pa.array(t.column("start").to_numpy()[row] + at), pa.array(n),
                         t.column("doc_tokens").take(take), pa.array(shard * shard_windows + number), pa.array(offset), packed], schema=kind)

    return run


def pack_documents(docs: DataFrame, tokenizer_file: str, weights: dict[str | None, int] | None = None, end_id: int = END_ID,
                   window: int = WINDOW, shard_windows: int = SHARD_WINDOWS, slack: int = SLACK, doc_col: str = "doc_id",
                   text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each piece: doc_id, source_queue, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are little-endian unsigned 32-bit integers.  ``weights`` are whole numbers above 0 by source (a source not
    named weighs 1); None: each source weighs its own number of tokens.
    """
    from tokenizers import Tokenizer

    bounded_batches(docs.sparkSession, BATCH_BYTES)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"),
                    F.spark_partition_id().alias("part"))
    encoded = materialize(d.mapInArrow(_encode(tokenizer_file, end_id), ENCODED), "pack-ids")
    sums = materialize(encoded.groupBy("part", "source").agg(F.sum("n_tokens").alias("tokens")), "pack-sums")
    # one queue a source while they fit a window, hash groups of sources beyond
    if sums.select("source").distinct().count() <= MAX_QUEUES:
        key = F.col("source")
    else:
        key = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()), F.lit(MAX_QUEUES)).cast("string")
    sums = sums.withColumn("key", key)
    totals = sorted(((r.key, r.tokens) for r in sums.groupBy("key").agg(F.sum("tokens").alias("tokens")).collect()),
                    key=lambda r: (r[0] is None, r[0] or ""))  # at most MAX_QUEUES rows
    size = [n for _, n in totals]
    weight = size if weights is None else [weights.get(k, 1) for k, _ in totals]
    number = F.array_position(F.array(*[F.coalesce(F.lit(k), F.lit("")) if k is not None else F.lit("\0null") for k, _ in totals]),
                              F.coalesce("key", F.lit("\0null"))) - 1 if totals else F.lit(0)
    before = Window.partitionBy("key").orderBy("part", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("part").alias("p"), F.col("source").alias("s"), number.cast("int").alias("queue"),
                       F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    placed = encoded.join(base, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "queue", (F.col("base") + F.col("place")).alias("place"), "n_tokens", "ids")
    width = "<u2" if Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 1 << 16 else "<u4"
    cut = placed.mapInArrow(_cut(size, weight, window * shard_windows), CUT)
    return cut.groupBy("shard").applyInArrow(_serve(weight, width, window, shard_windows, slack), PIECES)
