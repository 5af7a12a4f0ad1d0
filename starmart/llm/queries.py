"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (brown, collocations, decontam, fingerprints, html_extract, langid, line_dedup, mixing, packing,
                          substring_dedup, token_align, token_store, vptree)
from starmart.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Write ``docs`` as token files to ``path``; one row per document read back from them."""
    spark = docs.sparkSession
    token_store.write_tokens(docs, path, tokenizer_file())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), token_store.ids_crc32(b.column("ids"))],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return token_store.read_tokens(spark, path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), token_store.scratch(spark))


def op4_brown_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_probe(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves 1 modulo 3 (null id: no)."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(~held_out()))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = docs.select("doc_id", held_out().alias("held_out"), langid.predict_column(F.col("text"), language_model(docs), spark).alias("p"))
    return got.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vptree.simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return token_align.align(table(spark, sf_dir, "documents"), *files)[0]


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_extraction, op2_source_mixing, op3_token_output, op4_brown_scoring, op5_substring_dedup, op6_line_dedup,
        op7_simhash_fingerprints, op8_language_id, op9_decontamination, op10_simhash_near_dedup,
        op11_mixture_packing, op12_phrase_collocations, op13_token_alignment)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    # targets by trying every number of capped sources; taken from each document's place on the axis
    "op2_source_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('{mixing.SEED}' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
w AS (SELECT a.source, a.source_size, a.weight, 3.0::DOUBLE * a.source_size / a.weight AS ratio FROM s a),
levels AS (
  SELECT x.ratio, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * y.source_size) FILTER (y.ratio < x.ratio), 0))::DOUBLE
         / (sum(y.weight) FILTER (y.ratio >= x.ratio))::DOUBLE AS level
  FROM (SELECT DISTINCT ratio FROM w) x, w y GROUP BY x.ratio),
lvl AS (SELECT min_by(level, ratio) AS level FROM levels WHERE level <= ratio),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * level) AS target FROM w, lvl),
q AS (SELECT *, least(round(target)::BIGINT, 3 * source_size) AS quota FROM t),
a AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM d)
SELECT doc_id, size, q.source_size, q.target,
  (CASE WHEN size = 0 THEN 0 ELSE (quota // q.source_size) * size + greatest(0, least(quota % q.source_size, begins + size) - begins) END)::BIGINT AS taken
FROM a JOIN q ON a.source IS NOT DISTINCT FROM q.source
""",
    "op5_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
least_doc AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN least_doc USING (h) WHERE doc_id > lo),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op9_decontamination": rf"""
WITH tok AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT 'i', item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+') FROM benchmark WHERE text IS NOT NULL),
sh AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT kind, id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM tok WHERE len(w) > 0)),
item AS (SELECT id AS item_id, g, count(*) OVER (PARTITION BY id) AS size FROM sh WHERE kind = 'i')
SELECT d.id AS doc_id, item_id, count(*)::BIGINT AS shared, any_value(size)::BIGINT AS size, count(*)::DOUBLE / any_value(size) AS containment
FROM item JOIN sh d ON d.kind = 'd' AND d.g = item.g GROUP BY d.id, item_id HAVING count(*) >= 0.8 * any_value(size)
""",
    "op12_phrase_collocations": rf"""
WITH piece AS (SELECT lang, regexp_extract_all(x, '[^\x20\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS x FROM documents)),
place AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM piece WHERE len(w) > 0),
f AS (SELECT lang, k, w[i:i + k - 1] AS ph, count(*) AS f FROM place, (VALUES (1), (2), (3), (4)) AS t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT c.lang, c.ph, c.f, c.j, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS s
        FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c) c
        JOIN f l ON l.lang = c.lang AND l.ph = c.ph[1:c.j] JOIN f r ON r.lang = c.lang AND r.ph = c.ph[c.j + 1:c.k]),
worst AS (SELECT lang, ph, f, l, r, s FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY s, j) = 1),
part AS (SELECT DISTINCT lang, ph[i:i + m - 1] AS ph, f FROM (
  SELECT lang, ph, f, m, unnest(generate_series(1, k - m + 1)) AS i FROM c, (VALUES (2), (3)) AS t(m) WHERE m < k)),
kept AS (SELECT * FROM worst w WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.lang = w.lang AND p.ph = w.ph AND 100::HUGEINT * p.f >= 80::HUGEINT * w.f)),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY s DESC, f DESC, array_to_string(ph, ' '))::BIGINT AS rank,
  array_to_string(ph, ' ') AS phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, s::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
""",
}
