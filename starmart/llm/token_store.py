"""Token ids as Parquet: encode, write, read back selectively.

Documents are range-partitioned and sorted by doc_id, so the files hold them in
ascending order; ids are a ``list<int>`` column, dictionary-encoded (a
vocabulary fits one dictionary page), and the metadata columns are
delta-encoded, without dictionary.  Row groups and pages have set sizes, and
Parquet's page indexes are written, so a reader of a few documents touches few
pages and a reader of metadata never touches the ids (``read_metadata``,
``read_tokens``).  A document's ``start`` is the base of its part (a sum
over the one-row-per-part table) plus its offset inside the part, which the
encoder counts as it goes.

Encoding: a text splits at ASCII white space, which every vocabulary used here
drops, and distinct chunks are encoded by the tokenizers library once per worker
(a bounded cache).  ``whole=True`` encodes each text in one call, for
tokenizers that keep white space.

Defined cases: a null or empty text is the end id alone; null doc_ids come first
and are written; repeated rows are each written, in order of a text hash; an
empty table gives empty files; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches, release, text_slices
from starmart.session import scratch_path

END_ID = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
CACHE_WORDS = 200_000
#: text encoded at once, and Arrow batch, in bytes
BATCH_BYTES = 4 << 20
SCHEMA = "doc_id long, part int, offset long, n_tokens long, ids array<int>"
WRITER = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "v2",  # delta encodings for columns without dictionary
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part": "true",
    "parquet.enable.dictionary#offset": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}
#: Trailing ASCII marks that the pre-tokenizer always parts from a word (no apostrophe, no angle brackets or bars).
MARKS = ".,!?;:$%&*#()"
#: Lower-case words of letters below U+0250: one run for the pre-tokenizer, unchanged by the normaliser.
_PLAIN = re.compile("[a-zß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĵķĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżž]+").fullmatch
#: The byte-level alphabet as a rule: printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in order.
_ALPHABET = dict(zip((b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)), range(256, 512)))
_held: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """Ids of white-space separated chunks, through a cache of words in two generations (the older one is dropped when the newer is full)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def words(self, words: list[str]) -> list[bytes]:
        """Ids (int32 bytes) of each word."""
        new, old = self.new, self.old
        out = list(map(new.get, words))
        todo = [i for i, x in enumerate(out) if x is None]
        other, at = [], []
        for i in todo:
            w = words[i]
            got = old.get(w)
            if got is None:
                if not _PLAIN(w):
                    other.append(w)
                    at.append(i)
                    continue
                got = array("i", [t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(_ALPHABET))]).tobytes()
            out[i] = new[w] = got
        for i, w, e in zip(at, other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False) if other else ()):
            out[i] = new[w] = np.array(e.ids, np.int32).tobytes()
        if len(new) > CACHE_WORDS:
            self.old, self.new = new, {}
        return out

    def chunks(self, chunks: pa.Array) -> list[bytes]:
        """Ids (int32 bytes) of each distinct chunk: a word and the marks that end it are looked up apart."""
        special = pc.match_substring_regex(chunks, r"[<|]")  # may hold a special token: as it is
        low = pc.ascii_lower(chunks)
        core = pc.utf8_rtrim(low, MARKS)
        parted = pc.and_(pc.match_substring_regex(core, r"[\p{L}\p{N}]$"), pc.invert(special))
        core = pc.if_else(parted, core, pc.if_else(special, chunks, low))
        coded = core.dictionary_encode()
        ids = self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        out = [ids[i] for i in coded.indices.to_numpy().tolist()]
        cut = pc.binary_length(core).to_numpy()
        tail = np.flatnonzero(pc.binary_length(chunks).to_numpy() > cut)
        ends = [c.encode()[k:].decode() for c, k in zip(chunks.take(pa.array(tail)).to_numpy(zero_copy_only=False), cut[tail].tolist())]
        for i, x in zip(tail.tolist(), self.words(ends)):
            out[i] += x
        return out

    def texts(self, text: pa.Array, whole: bool, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each ended by ``end_id``; counts)."""
        if whole:
            got = [np.array(e.ids + [end_id], np.int32) for e in self.tokenizer.encode_batch_fast(
                [t or "" for t in text.to_pylist()], add_special_tokens=False)]
            return (np.concatenate(got) if got else np.empty(0, np.int32)), np.array([len(x) for x in got], np.int64)
        lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
        coded = lists.flatten().dictionary_encode()
        codes, ends = coded.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        each = self.chunks(coded.dictionary)
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        flat = np.frombuffer(b"".join(each), np.int32)
        start = np.cumsum(size) - size
        n = size[codes]
        total = np.concatenate(([0], np.cumsum(n)))
        count = total[ends[1:]] - total[ends[:-1]]
        at = np.arange(total[-1]) - np.repeat(total[:-1] - start[codes], n)
        out = np.full(total[-1] + len(count), end_id, np.int32)
        gap = np.ones(len(out), bool)
        gap[np.cumsum(count + 1) - 1] = False
        out[gap] = flat[at]
        return out, count + 1


def encoder(path: str) -> Encoder:
    """The worker's encoder (kept between tasks of one worker)."""
    key = (path, os.getpid())
    if key not in _held:
        _held[key] = Encoder(path)
    return _held[key]


def _encode(path: str, whole: bool):
    kind = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, offset = encoder(path), 0
        for b in batches:
            for lo, hi in text_slices(b.column("text"), BATCH_BYTES):
                ids, count = enc.texts(b.column("text").slice(lo, hi - lo), whole)
                at = np.concatenate(([0], np.cumsum(count)))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("part").slice(lo, hi - lo),
                                                  pa.array(offset + at[:-1]), pa.array(count), lists], schema=kind)
                offset += int(at[-1])
                release()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, doc_col: str = "doc_id", text_col: str = "text",
                 whole: bool = False, partitions: int | None = None) -> None:
    """Encode all rows and write them to ``path`` in ascending doc_id order."""
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = d.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    d.mapInArrow(_encode(tokenizer_file, whole), SCHEMA).write.options(**WRITER).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens) of all documents, without reading any ids."""
    meta = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "part", "offset", "n_tokens")
    return _with_start(meta, meta).select("doc_id", "start", "n_tokens")


def _with_start(rows: DataFrame, meta: DataFrame) -> DataFrame:
    sums = meta.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("part").alias("base_part"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), F.col("part") == F.col("base_part")).withColumn("start", F.col("base") + F.col("offset"))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids), of doc_ids from ``first`` to ``last`` if given (pushed down to row groups and pages)."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    meta = rows.select("part", "n_tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return _with_start(rows, meta).select("doc_id", "start", "n_tokens", "ids")


def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each list's ids as little-endian 32-bit integers."""
    at, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
    raw = memoryview(flat).cast("B")
    return pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())


def scratch(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-tokens")
