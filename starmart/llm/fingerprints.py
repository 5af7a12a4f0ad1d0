"""Document fingerprints: SimHash in DataFrame functions only.

Terms are the adjacent pairs of a text's lower-cased words (a single word is a
term of its own); a term's weight is its number of occurrences.  Each term's
64-bit hashes vote on the fingerprint's signed bits: with ``+weight`` where the
hash bit is 1, ``-weight`` where it is 0; a positive sum sets the bit.  Two bits'
votes share one 64-bit sum (32 bits each: no text holds 2^31 terms), so a word
of 64 bits takes 32 sums, added on the map side; only one row for each text is
shuffled.

Near search (``within_radius``) uses permuted block tables: the bits are cut into
``radius + extra`` blocks, each table brings ``extra`` of them to the front as its
key, and ``radius`` differing bits always leave one table's key equal, so an
equi-join per table finds all pairs; equal fingerprints collapse first.

Defined cases: a null or empty text, or one without words, has fingerprint zero;
equal texts have equal fingerprints; ties (a vote of zero) leave the bit 0;
repeated rows are kept, each in its place in the order; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import materialize

WORDS = 2  # 64-bit words of a fingerprint
SALT = "second"
#: one bit in each half of a 64-bit sum
LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Array of a text's lower-cased words."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def votes(rows: DataFrame, keys: list[str], text: str, n_words: int = WORDS) -> DataFrame:
    """``keys`` (unique) and the fingerprint as ``n_words`` longs fp0, fp1, ..."""
    named = rows.select(*keys, words_of(F.col(text)).alias("w"))
    pairs = F.transform("w", lambda w, i: F.xxhash64(w, F.get("w", i + 1)))
    single = F.when(F.size("w") > 1, F.slice(pairs, 1, F.greatest(F.size("w") - 1, F.lit(1)))).otherwise(pairs)
    each = named.select(*keys, F.explode_outer(single).alias("h0"))
    for k in range(1, n_words):
        each = each.withColumn(f"h{k}", F.when(F.col("h0").isNotNull(), F.xxhash64("h0", F.lit(SALT), F.lit(k))))
    sums = [F.sum(F.shiftright(f"h{k}", j).bitwiseAND(F.lit(LANES))).alias(f"s{k}_{j}") for k in range(n_words) for j in range(32)]
    got = each.groupBy(*keys).agg(F.count("h0").alias("n"), *sums)
    prints = []
    for k in range(n_words):
        bits = F.lit(0).cast("long")
        for j in range(32):
            s = F.coalesce(F.col(f"s{k}_{j}"), F.lit(0))
            low, high = s.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(s, 32)
            bits = bits.bitwiseOR(F.when(2 * low > F.col("n"), F.lit(1 << j)).otherwise(F.lit(0).cast("long")))
            top = 1 << (32 + j) if j < 31 else -(1 << 63)
            bits = bits.bitwiseOR(F.when(2 * high > F.col("n"), F.lit(top)).otherwise(F.lit(0).cast("long")))
        prints.append(bits.alias(f"fp{k}"))
    return got.select(*keys, *prints)


def as_hex(names: list[str]) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(n), 16, "0")) for n in names])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """1 - differing bits / bits."""
    apart = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)), F.lit(0))
    return 1 - apart / F.lit(64.0 * len(a))


def ordered(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, nth, doc_id, text, next_text): rows by ascending doc_id (nulls first, ties by text hash), each with its successor's text.

    Buckets are ranges of doc_id from quantiles, ordered inside; a bucket's last
    row gets the first text of the next bucket that has rows, the very last row
    the very first text.
    """
    d = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = 4 * int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(d.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n)))
    edges = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    bucket = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))), F.lit(0)) if len(cuts) else F.lit(0)
    d = d.withColumn("bucket", F.when(F.col("doc_id").isNull(), 0).otherwise(bucket)).withColumn("tkey", F.xxhash64("text"))
    inside = Window.partitionBy("bucket").orderBy("doc_id", "tkey")
    rows = d.select("bucket", F.row_number().over(inside).alias("nth"), "doc_id", "text",
                    F.lead(F.struct("text")).over(inside).alias("next"))
    # first rows: which row leads each bucket, then its text
    lead = d.groupBy("bucket").agg(F.min(F.struct("doc_id", "tkey")).alias("l"))
    by_bucket = Window.orderBy("bucket")
    lead = lead.select(F.lag("bucket").over(by_bucket).alias("before"), F.max("bucket").over(Window.partitionBy()).alias("top"),
                       F.col("l.doc_id").alias("ld"), F.col("l.tkey").alias("lt"))
    lead = lead.select(F.coalesce("before", "top").alias("before"), "ld", "lt")
    first = d.join(F.broadcast(lead), F.col("doc_id").eqNullSafe(F.col("ld")) & (F.col("tkey") == F.col("lt"))).groupBy(
        F.col("before")).agg(F.first(F.struct("text")).alias("first"))
    rows = rows.join(first.withColumn("ends", F.lit(True)), (F.col("bucket") == F.col("before")) & F.col("next").isNull(), "left")
    return rows.select("bucket", "nth", "doc_id", "text", F.coalesce("next", "first")["text"].alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half replaced by as many code points (or all) from the start of the next."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def edit_probe(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS) -> DataFrame:
    """Fingerprints of every text, its edited text and the likeness to that and to the next document."""
    rows = ordered(docs, doc_col, text_col).select(
        "bucket", "nth", "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("next_text", F.lit("")).alias("next_text"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    both = rows.select("bucket", "nth", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")),
                                         F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t")))).alias("x"))
    both = both.select("bucket", "nth", "doc_id", "n_chars", "edited_sha256", F.col("x.kind").alias("kind"), F.col("x.t").alias("t"))
    names = [f"fp{k}" for k in range(n_words)]
    got = votes(both, ["bucket", "nth", "doc_id", "n_chars", "edited_sha256", "kind"], "t", n_words)
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct(*names)))
    prints = materialize(got.groupBy("bucket", "nth", "doc_id", "n_chars", "edited_sha256").agg(
        pick(0).alias("own"), pick(1).alias("changed")), "fingerprints")
    inside = Window.partitionBy("bucket").orderBy("nth")
    by_bucket = Window.orderBy("bucket")
    first = prints.where("nth = 1").select("bucket", F.col("own").alias("first"))
    first = first.select(F.coalesce(F.lag("bucket").over(by_bucket), F.max("bucket").over(Window.partitionBy())).alias("before"), "first")
    out = prints.withColumn("following", F.lead("own").over(inside)).join(F.broadcast(first), F.col("bucket") == F.col("before"), "left")
    out = out.withColumn("following", F.coalesce("following", "first"))
    part = lambda c: [F.col(f"{c}.{n}") for n in names]
    return out.select("doc_id", "n_chars", "edited_sha256", as_hex([f"own.{n}" for n in names]).alias("fingerprint"),
                      as_hex([f"changed.{n}" for n in names]).alias("edited_fingerprint"),
                      likeness(part("own"), part("changed")).alias("near_edited"), likeness(part("own"), part("following")).alias("near_next"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int, extra: int = 2) -> DataFrame:
    """(query, fp, apart): every stored 64-bit ``fp`` within ``radius`` bits of each ``fp`` of ``queries``, by permuted block tables."""
    blocks = radius + extra
    edge = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m

    def tables(d: DataFrame, name: str) -> DataFrame:
        keys = [F.struct(F.lit(n).alias("n"), F.col(name).bitwiseAND(F.lit(signed(sum(m)))).alias("key"))
                for n, m in enumerate(combinations(masks, extra))]
        return d.select(name, F.explode(F.array(*keys)).alias("k")).select(name, "k.n", "k.key")

    stored = tables(prints.select("fp").where("fp is not null").distinct(), "fp")
    asked = tables(queries.select(F.col("fp").alias("query")).where("query is not null").distinct(), "query")
    near = asked.join(stored, ["n", "key"]).withColumn("apart", F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))))
    return near.where(F.col("apart") <= radius).select("query", "fp", "apart").distinct()
