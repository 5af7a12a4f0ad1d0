"""Cross-tokenizer alignment: links and common cuts of two tokenisations of the same bytes.

A text's tokens under both vocabularies are byte ranges over the same bytes.
Lockstep merging finds their overlaps: a state vector holds, for every document
of a batch, a pointer into its A tokens and one into its B tokens.  Each step
emits one link per document (the two tokens pointed at), a cut where both end
together, and moves on the pointer whose token ends first (both at a cut);
finished documents are compacted away.  Documents longer than ``LANE_BYTES``
enter as several lanes, each starting at the tokens that cover its first byte
and owning the links that begin inside it, so that the number of steps does not
grow with the longest document.

Counting links: each batch is a block that writes its documents' links as codes
into the block's list of distinct id pairs.  Spark sums, for each pair, the
documents that hold it, finds each A id's highest count (one row for each id of
the vocabulary), and sends counts back to the blocks that hold the pair.

Defined cases: texts null, empty, or not covered byte by byte by both
tokenisations have no tokens (zeros, an empty digest); special tokens' strings
are plain text; null doc_ids and repeated rows are documents like others; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, materialize, release, squeeze, text_slices, unsqueeze

LANE_BYTES = 512
#: text of one block, in bytes
BLOCK_BYTES = 2 << 20

#: rows of a block by code: -2 its links, -1 a document, 0 and more a pair of ids
BLOCKS = ("block long, code int, a int, b int, n_docs long, number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
          "groups_sha256 string, held binary, links binary, times binary")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_held: dict[tuple[str, str], tuple[ByteTokens, PieceTokens]] = {}


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, 256, 257, .. for the rest in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Tokens:
    """A vocabulary's token bytes, and decimal ids for digests, by id."""

    def __init__(self, table: list[bytes]):
        self.table = pa.array(table, pa.binary())
        self.size = np.fromiter(map(len, table), np.int64, len(table))


class ByteTokens(Tokens):
    """Byte-level BPE from a tokenizers file (its vocabulary, in order of rank) run by tiktoken on plain text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        alphabet = byte_alphabet()
        special = {t for t in vocab if any(c not in alphabet for c in t)} | {"<|endoftext|>"}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in special}
        table = [b""] * (max(vocab.values()) + 1)
        for t, i in ranks.items():
            table[i] = t
        super().__init__(table)
        self.model = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the number of ids of each)."""
        got = [self.model.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        ids = np.concatenate(got).astype(np.int32) if got else np.empty(0, np.int32)
        return ids, np.fromiter(map(len, got), np.int64, len(got))


class PieceTokens(Tokens):
    """A sentencepiece model; it puts the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        p = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode()
                          for i in range(p.get_piece_size())])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, the number of ids of each)."""
        got = self.model.encode(texts, num_threads=1)
        count = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int32, int(count.sum())), count


def tokenizers(byte_file: str, piece_file: str) -> tuple[ByteTokens, PieceTokens]:
    if (byte_file, piece_file) not in _held:
        _held[byte_file, piece_file] = ByteTokens(byte_file), PieceTokens(piece_file)
    return _held[byte_file, piece_file]


def _bounds(count: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(count)))


def covered(tokens: Tokens, ids: np.ndarray, count: np.ndarray, data: bytes, begin: np.ndarray) -> np.ndarray:
    """Which documents' joined token bytes are the bytes ``begin[i]:begin[i + 1]`` of ``data``."""
    joined = tokens.table.take(pa.array(ids))
    size = _bounds(tokens.size[ids])[_bounds(count)]
    same = np.diff(size) == np.diff(begin)
    raw = np.frombuffer(joined.buffers()[2] if len(ids) else b"", np.uint8)[:size[-1]]
    if same.all():
        differ = np.flatnonzero(raw != np.frombuffer(data, np.uint8))
        same[np.searchsorted(begin, differ, side="right") - 1] = False
        return same
    view, whole = memoryview(raw.tobytes()), memoryview(data)
    for i in np.flatnonzero(same).tolist():
        same[i] = view[size[i]:size[i + 1]] == whole[begin[i]:begin[i + 1]]
    return same


def lockstep(end_a: np.ndarray, count_a: np.ndarray, end_b: np.ndarray, count_b: np.ndarray, size: np.ndarray,
             lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge A and B tokens of all documents at once.

    ``end_a``, ``end_b``: the byte after each token, over the documents laid end to end; ``size``: bytes of each document.
    Returns (A token, B token) of every link, in no set order, and (A token, B token) of every cut.
    """
    begin = _bounds(size)
    lanes = np.maximum(1, -(-size // lane_bytes))
    lanes[size == 0] = 0
    doc = np.repeat(np.arange(len(size)), lanes)
    step = np.arange(len(doc)) - np.repeat(_bounds(lanes)[:-1], lanes)
    at = begin[doc] + step * lane_bytes
    stop = np.minimum(at + lane_bytes, begin[doc + 1])
    a, b = (np.searchsorted(e, at, side="right").astype(np.int32) for e in (end_a, end_b))
    start_a, start_b = np.concatenate(([0], end_a)), np.concatenate(([0], end_b))
    # a link belongs to the lane in which it begins: one that began before is the last lane's
    early = np.maximum(start_a[a], start_b[b]) < at if len(at) else np.empty(0, bool)
    mine = ~early
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        ends_a, ends_b = end_a[a], end_b[b]
        cut = ends_a == ends_b
        if mine is not None:
            links_a.append(a[mine])
            links_b.append(b[mine])
            cut &= mine
            mine = None
        else:
            links_a.append(a)
            links_b.append(b)
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        here = np.minimum(ends_a, ends_b)  # where the next link begins
        live = here < stop
        a, b = a + (ends_a <= ends_b), b + (ends_b <= ends_a)
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    none = np.empty(0, np.int32)
    return tuple(np.concatenate(x) if x else none for x in (links_a, links_b, cuts_a, cuts_b))


def digests(ids_a: np.ndarray, count_a: np.ndarray, ids_b: np.ndarray, count_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray,
            names_a: pa.Array, names_b: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(groups of each document, its digest); ``cut_*``: the last tokens of the groups, in order."""
    group = np.searchsorted(cut_a, np.arange(len(ids_a)), side="left")  # the group of each A token
    last_a = np.zeros(len(ids_a), bool)
    last_a[cut_a] = True
    last_b = np.zeros(len(ids_b), bool)
    last_b[cut_b] = True
    before_b = np.concatenate(([0], cut_b + 1))
    # a group's A tokens, then its B tokens
    place_a = np.arange(len(ids_a)) + before_b[group]
    group_b = np.searchsorted(cut_b, np.arange(len(ids_b)), side="left")
    place_b = np.arange(len(ids_b)) + (cut_a + 1)[group_b]
    kinds = len(names_a)
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a] = ids_a * 2 + last_a
    code[place_b] = kinds + ids_b.astype(np.int64) * 2 + last_b
    names = pa.concat_arrays([names_a, names_b])
    text = names.take(pa.array(code))
    offset = np.frombuffer(text.buffers()[1], np.int32)[:len(code) + 1]
    raw = memoryview(text.buffers()[2]) if len(code) else memoryview(b"")
    bound = _bounds(count_a + count_b)
    ends = offset[bound].tolist()
    out = [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(ends[:-1], ends[1:])]  # without the last ;
    groups = np.diff(np.searchsorted(cut_a, _bounds(count_a), side="left"))
    return groups, out


@cache
def _names(n: int, inner: str, last: str) -> pa.Array:
    return pa.array([f"{i}{mark}" for i in range(n) for mark in (inner, last)], pa.binary())


def _align(byte_file: str, piece_file: str, lane_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok_a, tok_b = tokenizers(byte_file, piece_file)
        names_a, names_b = _names(len(tok_a.table), ",", "|"), _names(len(tok_b.table), ",", ";")
        number = 0
        for batch in batches:
            for lo, hi in text_slices(batch.column("text"), BLOCK_BYTES):
                texts = [t or "" for t in batch.column("text").slice(lo, hi - lo).to_numpy(zero_copy_only=False)]
                some = [t for t in texts if t]
                place = np.flatnonzero(np.fromiter(map(bool, texts), bool, len(texts)))
                raw = [b" " + t.encode() for t in some]
                begin, data = _bounds(np.fromiter(map(len, raw), np.int64, len(raw))), b"".join(raw)
                ids_a, count_a = tok_a.encode(some)
                ids_b, count_b = tok_b.encode(some)
                good = covered(tok_a, ids_a, count_a, data, begin) & covered(tok_b, ids_b, count_b, data, begin)
                if not good.all():
                    ids_a, ids_b = ids_a[np.repeat(good, count_a)], ids_b[np.repeat(good, count_b)]
                    count_a, count_b, place = count_a[good], count_b[good], place[good]
                size = np.diff(begin)[good]
                link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(tok_a.size[ids_a]), count_a, np.cumsum(tok_b.size[ids_b]), count_b, size, lane_bytes)
                cut_a.sort()
                cut_b.sort()
                groups, digest = digests(ids_a, count_a, ids_b, count_b, cut_a, cut_b, names_a, names_b)
                # distinct pairs of the block, and each document's pairs with their times
                doc = np.repeat(np.arange(len(size)), count_a)[link_a]
                width = len(tok_b.table)
                pairs, code = np.unique(ids_a[link_a].astype(np.int64) * width + ids_b[link_b], return_inverse=True)
                held, times = np.unique(doc * max(1, len(pairs)) + code, return_counts=True)
                owner, code = held // max(1, len(pairs)), (held % max(1, len(pairs))).astype(np.int32)
                bound = np.searchsorted(owner, np.arange(len(size) + 1))
                n_docs = np.bincount(code, minlength=len(pairs))
                block = (batch.column("part")[lo].as_py() << 32) + number
                number += 1
                yield from _block_rows(block, batch.column("doc_id").slice(lo, hi - lo), pairs, width, n_docs, place, count_a, count_b, groups,
                                       np.bincount(doc, minlength=len(size)), digest, bound, code, times.astype(np.int32))
                release()

    return run


def _block_rows(block: int, doc_id: pa.Array, pairs: np.ndarray, width: int, n_docs: np.ndarray, place: np.ndarray, count_a: np.ndarray,
                count_b: np.ndarray, groups: np.ndarray, links: np.ndarray, digest: list[str], bound: np.ndarray, code: np.ndarray,
                times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row with the links (packed), one for each document, one for each distinct pair; ``place``: documents that have tokens."""
    n, m = len(doc_id), len(pairs)

    def spread(values: np.ndarray) -> pa.Array:
        full = np.zeros(n, np.int64)
        full[place] = values
        return pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(full), pa.nulls(m, pa.int64())])

    def documents(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.nulls(1, values.type), values, pa.nulls(m, values.type)])

    def of_pairs(values: np.ndarray) -> pa.Array:
        values = pa.array(values)
        return pa.concat_arrays([pa.nulls(1 + n, values.type), values])

    def head(value: bytes) -> pa.Array:
        return pa.array([value] + [None] * (n + m), pa.binary())

    texts, held = np.full(n, "", object), np.zeros(n, np.int32)
    texts[place], held[place] = digest, np.diff(bound)
    kind = np.concatenate(([-2], np.full(n, -1), np.arange(m))).astype(np.int32)
    yield from pa.table({
        "block": pa.array(np.full(1 + n + m, block)), "code": pa.array(kind), "a": of_pairs((pairs // width).astype(np.int32)),
        "b": of_pairs((pairs % width).astype(np.int32)), "n_docs": of_pairs(n_docs.astype(np.int64)), "number": documents(pa.array(np.arange(n, dtype=np.int32))),
        "doc_id": documents(doc_id), "n_a": spread(count_a), "n_b": spread(count_b), "n_groups": spread(groups), "n_links": spread(links),
        "groups_sha256": documents(pa.array(texts, pa.string())), "held": head(squeeze(held)),
        "links": head(squeeze(np.diff(code, prepend=np.int32(0)))), "times": head(squeeze(times))}).to_batches()


def _count_back(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a block with the corpus-wide counts of their links."""
    head = rows.filter(pc.equal(rows.column("code"), -2))
    docs = rows.filter(pc.equal(rows.column("code"), -1))
    held, code, times = (unsqueeze(head.column(c)[0].as_py(), np.int32) for c in ("held", "links", "times"))
    code, times = np.cumsum(code), times.astype(np.int64)
    count, top = np.zeros((2, counts.num_rows), np.int64)  # every pair of the block comes back
    at = counts.column("code").to_numpy()
    count[at], top[at] = counts.column("count").to_numpy(), counts.column("top").to_numpy()
    sums = (_bounds(count[code] * times), _bounds((count[code] == top[code]) * times))
    bound = _bounds(held)
    number = docs.column("number").to_numpy()
    total, best = (pa.array((s[bound[1:]] - s[bound[:-1]])[number]) for s in sums)
    same = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(docs.column(c) for c in same), best, total, docs.column("groups_sha256")], names=[*same, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, byte_file: str, piece_file: str, lane_bytes: int = LANE_BYTES, doc_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; pairs: a, b, count (documents that
    link the two ids), top (the highest count of the A id).
    """
    bounded_batches(docs.sparkSession, BLOCK_BYTES)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.spark_partition_id().cast("long").alias("part"))
    blocks = materialize(d.mapInArrow(_align(byte_file, piece_file, lane_bytes), BLOCKS), "align-blocks")
    entries = blocks.where("code >= 0").select(F.col("block").alias("at"), F.col("code").alias("pair"), "a", "b", "n_docs")
    pairs = materialize(entries.groupBy("a", "b").agg(F.sum("n_docs").alias("count")), "align-pairs")
    best = pairs.groupBy(F.col("a").alias("best_a")).agg(F.max("count").alias("top"))  # one row for each id of the vocabulary
    pairs = pairs.join(best, F.col("a") == F.col("best_a")).select("a", "b", "count", "top")
    back = entries.select("at", "pair", "a", "b").join(pairs, ["a", "b"]).select("at", F.col("pair").alias("code"), "count", "top")
    rows = blocks.where("code < 0").drop("a", "b", "n_docs").groupBy("block")
    return rows.cogroup(back.groupBy("at")).applyInArrow(_count_back, RESULT), pairs
