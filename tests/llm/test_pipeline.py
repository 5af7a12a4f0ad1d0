"""Queries against their SQL and the pipeline's stages, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from starmart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name]).df()
    got = queries.REGISTRY[name](spark, SF).toPandas()[list(want.columns)]
    columns = sorted(want.columns)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert a.shape == b.shape and (a == b).all().all()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs
        if name != "token_output":
            assert docs.columns == columns
        if name in ("language_id", "simhash_near_dedup", "benchmark_decontamination"):
            assert docs.exceptAll(before).count() == 0
    assert kept["language_id"].count() >= 0.99 * spark.read.parquet(f"{SF}/documents.parquet").where("text rlike '[a-z]'").count()
    groups = queries.vptree.simhash_groups(kept["language_id"])
    assert kept["simhash_near_dedup"].count() == groups.select("component_id").distinct().count()
    leaks = queries.decontam.find_leaks(kept["simhash_near_dedup"], spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct()
    assert kept["benchmark_decontamination"].count() == kept["simhash_near_dedup"].count() - leaks.count()
    tokens = kept["token_output"].orderBy("start").collect()
    assert len(tokens) == kept["source_mixing"].count() and tokens[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(tokens, tokens[1:]))


def test_pipeline_of_an_empty_table_and_of_rows_without_text(spark, tmp_path):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    whole.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "few" / "benchmark.parquet"))
    from pyspark.sql import functions as F

    blank = whole.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    whole.limit(60).unionByName(blank).unionByName(blank.withColumn("text", F.lit("")).withColumn("doc_id", F.lit(None).cast("long"))).write.parquet(
        str(tmp_path / "few" / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "few"))
    assert got.count() > 30 and got.where("doc_id is null").count() == 0
