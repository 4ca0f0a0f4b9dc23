"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

from changelake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, cur.fetchall()))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as cp
    from changelake.llm.common import materialize
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = materialize(stage(spark, docs, sf_dir), "t-stage")
        if k < 4:
            assert out.columns == docs.columns, name
        if k == 0:
            kept = clean.join(out, "doc_id", "left_semi").count()
            assert kept >= 0.95 * clean.join(docs, "doc_id", "left_semi").count() and out.count() < docs.count()
        if k in (1, 3, 4):
            assert out.count() == docs.count()
        if k == 1:
            assert out.where(F.col("n_chars") != F.length("text")).count() <= docs.where(F.col("n_chars") != F.length("text")).count()
        if k == 2:
            found = QUERIES["op1_simhash_dedup"]
            from changelake.llm.simhash import simhash_dedup
            assert found and out.count() == simhash_dedup(docs).select("component_id").distinct().count()
        docs = out
    assert "ids" in docs.columns


def test_pipeline_on_odd_documents(spark, odd_docs, sf_dir):
    import corpus_pipeline as cp
    docs = odd_docs.withColumn("slot", F.lit(1)).withColumn("score", F.lit("x"))
    for k, (_, stage) in enumerate(cp.STAGES):
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, sf_dir)
            assert k == 4 or out.columns == docs.columns
            out.collect()
