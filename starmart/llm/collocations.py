"""Phrase collocations by set-oriented mining: occurrence relations, merge-joins, group counts, semi-joins.

The occurrence relation of phrases of ``k`` words holds one row for each place
where such a phrase starts, in order of (piece, position).  It is stored in
blocks: a block is a run of whole documents, its rows are two columns of
numbers (the phrase's code in the block, and whether a piece starts here).

For each length:

1. group-count: every block gives its distinct phrases with their counts, dealt
   by a hash of the phrase to buckets, whose number grows with the table.  A block's
   share of a bucket is sorted and packed.  A bucket is one task, which sums the
   counts; phrases below ``MIN_COUNT`` are dropped;
2. semi-join: a Bloom filter of the frequent phrases, of a fixed number of bits
   whatever their number, goes to the blocks and takes infrequent phrases out of
   the relation.  What it lets through by chance is counted like the rest and
   dropped by its count: results are exact, a full filter only saves less;
3. merge-join: the relation is joined with itself on equal piece and adjacent
   position.  Two phrases of ``k`` words that overlap in ``k - 1`` are one of
   ``k + 1``.  A phrase with an infrequent part cannot be frequent, so none is lost.

Word pairs are worked out twice, for their counts and for the triples, rather
than written: they take more room than all else.

Blocks name a word by the XXH64 of its language and text, a phrase by its words'
hashes.  That no two words of the table share a hash is checked over the whole
vocabulary; if two did, mining would start again under another salt.  The
``SHORT`` commonest words, a fixed number, are renamed to their rank after the
first count, which packs better; no hash of the vocabulary is a rank.  The joins
that name phrases are over frequent phrases only.  A frequent phrase carries the
counts of all its first and last parts along (``pre``, ``suf``), so cuts are
scored without another search.

Defined cases: a null or empty text has no words; a null language is ``und`` and
joins documents that say so; repeated rows count each; a text of any length is
in one block; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.bloom import hash_longs, in_filter, key_filter
from starmart.llm.common import bounded_batches, materialize, release, squeeze, text_slices, unsqueeze

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: a phrase is dropped if a longer one that holds it has at least this share (in percent) of its count
COVERED = 80
SCALE = 2_000_000
UNKNOWN = "und"
#: text of one block, in bytes
BLOCK_BYTES = 8 << 20
#: words that get short names (their list, 8 bytes each, is broadcast)
SHORT = 1 << 17
#: phrases of all blocks in one bucket
BUCKET_ROWS = 1 << 20

BLOCK = "live long, hashes binary, parts binary, codes binary, starts binary"
WORDS = "lang string, word string, n long, " + BLOCK
#: Classes of bytes: 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def split_pieces(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words of all texts lower-cased, which of them start a piece, the text of each)."""
    n = len(text)
    size = pc.fill_null(pc.binary_length(text), 0).to_numpy().astype(np.int64)
    at = np.cumsum(size + 1) - 1 if n else np.empty(0, np.int64)  # a line feed ends each text
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pc.fill_null(text, "").cast(pa.binary())), b"\n")[0].as_py() or b""
    data = np.frombuffer(joined.lower() + b"\n", np.uint8)  # bytes.lower changes A-Z only
    kind = _KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    start = np.flatnonzero(first)
    chars = data[inside]
    if len(chars) >= 1 << 31:
        raise ValueError("a text of 2 GB or more")
    offset = np.append(np.searchsorted(np.flatnonzero(inside), start) if len(start) else [], len(chars)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offset), pa.py_buffer(chars)])
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    new = np.ones(len(start), bool)
    new[1:] = piece[1:] != piece[:-1]
    return words, new, np.searchsorted(at, start, side="left")


def _by_count(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, counts, code of each row); the commonest key is code 0, which keeps codes short."""
    distinct, row, count = np.unique(key, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return distinct[order], count[order], place[row]


def _pack_bits(bits: np.ndarray) -> bytes:
    return len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes()


def _unpack_bits(raw: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8, offset=8), count=int.from_bytes(raw[:8], "little")).astype(bool)


Relation = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _block(hashes: np.ndarray, parts: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> dict[str, object]:
    """A block's relation as values of one row; ``live``: its rows that hold a phrase."""
    return {"live": int((codes >= 0).sum()), "hashes": squeeze(hashes.view(np.int64)), "parts": squeeze(parts.astype(np.int32).reshape(-1)),
            "codes": squeeze(codes.astype(np.int32) + 1), "starts": _pack_bits(starts)}


def _blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[Relation]:
    """(hashes of words, phrases as rows of places in them, phrase of each row or -1, whether a piece starts there) of each block."""
    for b in batches:
        for raw, part, code, packed in zip(*(b.column(c).to_pylist() for c in ("hashes", "parts", "codes", "starts"))):
            yield unsqueeze(raw, np.int64), unsqueeze(part, np.int32).reshape(-1, k), unsqueeze(code, np.int32) - 1, _unpack_bits(packed)
            release()


_KINDS = {"live": pa.int64(), "hashes": pa.binary(), "parts": pa.binary(), "codes": pa.binary(), "starts": pa.binary()}


def _words(salt: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in text_slices(b.column("text"), BLOCK_BYTES):
                words, starts, owner = split_pieces(b.column("text").slice(lo, hi - lo))
                if not len(words):
                    continue
                coded, langs = words.dictionary_encode(), b.column("lang").slice(lo, hi - lo).dictionary_encode()
                width = len(langs.dictionary)
                key = coded.indices.to_numpy().astype(np.int64) * width + langs.indices.to_numpy()[owner]
                distinct, count, codes = _by_count(key)
                lang, word = langs.dictionary.take(pa.array(distinct % width)), coded.dictionary.take(pa.array(distinct // width))
                seeds = {x: xxhash.xxh64_intdigest(salt + x, 42) for x in langs.dictionary.to_pylist()}
                hashes = np.fromiter((xxhash.xxh64_intdigest(w, seeds[x]) for x, w in zip(lang.to_numpy(zero_copy_only=False), word.to_numpy(
                    zero_copy_only=False))), np.uint64, len(word))
                # a row with the block's relation, then one for each distinct word of it
                head = _block(hashes, np.arange(len(word)), codes, starts)
                columns = {"lang": lang, "word": word, "n": pa.array(count.astype(np.int64))}
                yield from pa.table({**{c: pa.concat_arrays([pa.nulls(1, v.type), v]) for c, v in columns.items()},
                                     **{c: pa.array([head[c]] + [None] * len(word), t) for c, t in _KINDS.items()}}).to_batches()
                release()

    return run


def renamed(hashes: np.ndarray, short: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Words by rank, if ``short`` (sorted hashes, their ranks) has them."""
    known, rank = short
    if not len(known):
        return hashes
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, rank[at], hashes)


def _renamed(short):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("w1")
            yield b.set_column(at, "w1", pa.array(renamed(b.column(at).to_numpy(), short.value)))

    return run


def lengthened(relation: Relation, held: np.ndarray) -> Relation:
    """Merge-join of a block's relation, cut down to frequent phrases, with itself on the next position."""
    hashes, parts, codes, starts = relation
    frequent = np.flatnonzero(in_filter(held, hashes[parts]))
    local = np.full(len(parts) + 1, -1, np.int64)
    local[frequent + 1] = np.arange(len(frequent))
    here = local[codes + 1]
    at = np.flatnonzero((here[:-1] >= 0) & (here[1:] >= 0) & ~starts[1:])
    wide = max(1, len(frequent))
    distinct, pair = np.unique(here[at] * wide + here[at + 1], return_inverse=True)
    codes = np.full(len(codes), -1, np.int32)
    codes[at] = pair
    parts = np.concatenate((parts[frequent[distinct // wide]], parts[frequent[distinct % wide]][:, -1:]), axis=1)
    used, place = np.unique(parts, return_inverse=True)
    return hashes[used], place.reshape(parts.shape).astype(np.int32), codes, starts


def _extended(batches: Iterator[pa.RecordBatch], k: int, short, filters: list) -> Iterator[Relation]:
    """The blocks' relations of ``k`` words, made longer by a word for each filter."""
    for hashes, *rest in _blocks(batches, k):
        relation = (renamed(hashes, short.value) if k == 1 else hashes, *rest)
        for bits in filters:
            relation = lengthened(relation, np.frombuffer(bits.value, np.uint8))
        yield relation


def _extend(k: int, short, filters: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for relation in _extended(batches, k, short, filters):
            row = _block(*relation)
            yield pa.RecordBatch.from_pydict({c: pa.array([row[c]], t) for c, t in _KINDS.items()})

    return run


def _deal(k: int, short, filters: list, buckets: int):
    """(bucket, w1, w2, .., n): each block's distinct phrases and their counts, sorted, as packed columns of a row for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, parts, codes, _ in _extended(batches, k, short, filters):
            if not len(parts):
                continue
            key, n = hashes[parts], np.bincount(codes[codes >= 0], minlength=len(parts))
            bucket = (hash_longs(key) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((*key.T[::-1], bucket))
            columns, n, bucket = np.ascontiguousarray(key[order].T), n[order], bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=-1))
            cut = list(zip(first.tolist(), [*first[1:].tolist(), len(bucket)]))
            words = {f"w{i + 1}": pa.array([squeeze(np.diff(x[lo:hi], prepend=0) if i == 0 else x[lo:hi]) for lo, hi in cut], pa.binary())
                     for i, x in enumerate(columns)}
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[first]), **words,
                                              "n": pa.array([squeeze(n[lo:hi].astype(np.int64)) for lo, hi in cut], pa.binary())})

    return run


def _summed(k: int, least: int):
    """One bucket's phrases that occur ``least`` times or more: w1, w2, .., f."""
    def run(t: pa.Table) -> pa.Table:
        columns = [[unsqueeze(x.as_py(), np.int64) for x in t.column(c)] for c in (*(f"w{i}" for i in range(1, k + 1)), "n")]
        columns[0] = [np.cumsum(x) for x in columns[0]]
        *key, n = (np.concatenate(c) for c in columns)
        order = np.lexsort(key[::-1])
        key, n = [c[order] for c in key], n[order]
        new = np.ones(len(n), bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in key], axis=0)
        first = np.flatnonzero(new)
        f = np.add.reduceat(n, first)
        kept = f >= least
        return pa.table({**{f"w{i + 1}": pa.array(c[first[kept]]) for i, c in enumerate(key)}, "f": pa.array(f[kept])})

    return run


def _clash(vocabulary: DataFrame) -> bool:
    """Whether two words share a hash, or a hash is a short name."""
    return not vocabulary.groupBy("w1").count().where(f"count > 1 OR w1 BETWEEN 0 AND {SHORT - 1}").isEmpty()


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n) with n the number of words, one table for each length).

    A table's rows: w1, w2, .. (hashes of its words), lang, words, f, pre, suf (counts of the first and last 1, 2, .. words).
    """
    spark = docs.sparkSession
    bounded_batches(spark, BLOCK_BYTES)
    d = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    salt = ""
    while True:
        relation = materialize(d.mapInArrow(_words(salt), WORDS), "occurrences-1", "zstd")
        words = relation.where("n IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("f"))
        words = materialize(words.withColumn("w1", F.xxhash64(F.concat(F.lit(salt), "lang"), "word")), "phrase-vocabulary", "zstd")
        if not _clash(words):
            break
        salt += "+"
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= min_count)
    common = frequent.orderBy(F.desc("f"), "w1").limit(SHORT).select("w1").toPandas()["w1"].to_numpy(np.int64)
    short = spark.sparkContext.broadcast((np.sort(common), np.argsort(common)))
    frequent = frequent.select("w1", "lang", "word", "f").mapInArrow(_renamed(short), "w1 long, lang string, word string, f long")
    tables = [frequent.select("w1", "lang", F.array("word").alias("words"), "f", F.array("f").alias("pre"), F.array("f").alias("suf"))]
    relation, held, filters = relation.where("n IS NULL").select(*_KINDS), 1, []  # ``held`` words, then one more for each filter
    for k in range(2, max_words + 1):
        part, key = [f"w{i}" for i in range(1, k)], [f"w{i}" for i in range(1, k + 1)]
        filters.append(spark.sparkContext.broadcast(key_filter(tables[-1], part).tobytes()))
        if 2 < k < max_words:  # pairs are too many to be written, the longest phrases are not read again
            relation, held, filters = materialize(relation.mapInArrow(_extend(held, short, filters), BLOCK), f"occurrences-{k}"), k, []
        buckets = int(relation.agg(F.sum("live")).first()[0] or 0) // BUCKET_ROWS + 1
        dealt = relation.mapInArrow(_deal(held, short, filters, buckets), "bucket int, " + ", ".join(f"{c} binary" for c in key) + ", n binary")
        counted = dealt.groupBy("bucket").applyInArrow(_summed(k, min_count), ", ".join(f"{c} long" for c in key) + ", f long")
        first = tables[-1].select(*part, "lang", F.col("words").alias("w"), F.col("pre").alias("p"))
        last = tables[-1].select(*[F.col(c).alias(n) for c, n in zip(part, key[1:])], F.element_at("words", -1).alias("x"), F.col("suf").alias("s"))
        longer = materialize(counted, f"phrases-{k}").join(first, part).join(last, key[1:]).select(
            *key, "lang", F.concat("w", F.array("x")).alias("words"), "f", F.concat("p", F.array("f")).alias("pre"),
            F.concat("s", F.array("f")).alias("suf"))
        tables.append(materialize(longer, f"phrases-named-{k}"))
    return sizes, tables


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, covered: int = COVERED,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: lang, rank, phrase, a, l, r, n, score."""
    sizes, tables = frequent_phrases(docs, min_count, max_words, text_col, lang_col)
    found = None
    for k in range(2, max_words + 1):
        here = tables[k - 1]
        # the best-scoring test is against the worst cut: the least (score, words before the cut)
        cut = (f"transform(sequence(1, {k - 1}), j -> struct(CAST({SCALE} AS DECIMAL(7,0)) * CAST(f AS DECIMAL(20,0)) div "
               f"(CAST(pre[j - 1] AS DECIMAL(20,0)) + CAST(suf[{k} - j - 1] AS DECIMAL(20,0))) AS score, j, pre[j - 1] AS l, suf[{k} - j - 1] AS r))")
        if k < max_words:  # a phrase inside a longer one is inside one of one word more, with at least the longer one's count
            key, longer = [f"w{i}" for i in range(1, k + 1)], [f"w{i}" for i in range(1, k + 2)]
            holder = tables[k].select(*key, F.col("f").alias("g")).unionAll(tables[k].select(*longer[1:], "f"))
            here = here.join(holder.groupBy(*key).agg(F.max("g").alias("g")), key, "left").where(
                f"g IS NULL OR 100 * CAST(g AS DECIMAL(20,0)) < {covered} * CAST(f AS DECIMAL(20,0))")
        here = here.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.array_min(F.expr(cut)).alias("cut"))
        found = here if found is None else found.unionAll(here)
    found = found.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").cast("long").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    found = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return found.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
