"""Corpus pipeline: raw documents to token files, five stages of the ``llm`` operators.

Every stage takes all that its predecessor kept and is written as Parquet and
reread before the next one.  A stage's output keeps the columns of documents.
``ORACLE_SQL`` is None: a learnt classifier and a tokenizer cannot be said in
SQL; tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontam, langid, mixing, token_store, vptree
from starmart.llm.common import bounded_batches, table
from starmart.llm.queries import encoded, language_model
from starmart.session import scratch_path

#: Language ID rejects a document whose calibrated score is below this, or that has no letter.
MIN_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a learnt language; text without letters, or of no clear language, goes."""
    bounded_batches(spark)
    p = langid.predict_column(F.col("text"), language_model(docs), spark)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), p.alias("p"))
    return marked.where((F.col("p.lang_pred") != langid.UNKNOWN) & (F.col("p.score") >= MIN_SCORE)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of each group of near copies."""
    return vptree.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is contained."""
    return decontam.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row, whole, for each document and epoch taken."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and one row per document read back from them."""
    return encoded(docs, token_store.scratch(spark))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("token_output", token_output),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage's rows are written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
