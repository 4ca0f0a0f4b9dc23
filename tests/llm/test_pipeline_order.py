"""What the pipeline's stages leave in its result."""

from collections import Counter
from functools import partial

from pyspark.sql import functions as F

from changelake.llm import mixing
from changelake.llm.common import materialize, numbered


def test_run_returns_the_mixture_position(spark, sf_dir, monkeypatch):
    import corpus_pipeline as cp
    monkeypatch.setattr(cp, "mixed_rows", partial(mixing.mixed_rows, block_rows=1, period=64))
    monkeypatch.setattr(cp, "STAGES", cp.STAGES[3:])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = cp.run(spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    rows = out.select("doc_id", "position").join(docs, "doc_id").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(docs.count()))
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    parts = mixing.components_of(counts)
    [level] = mixing.quota_levels(parts, parts.count(), period=64)
    target = {r.source: r.q / r.period for r in level.join(parts, level.member == parts.component).collect()}
    left, run = Counter({r.source: r.n for r in counts.collect()}), Counter()
    for t, r in enumerate(rows):  # until the first source has no documents left
        run[r.source] += 1
        assert all(abs(run[s] - (t + 1) * target[s]) < 1 for s in target)
        if run[r.source] == left[r.source]:
            break
    assert t > 20


def test_numbered_follows_the_written_order(spark):
    rows = spark.range(0, 1000, 1, 7).select("id", F.expr("repeat('x', int(1000 - id))").alias("doc"), F.lit(1).alias("a.b"))
    written = materialize(rows, "t-numbered").repartition(5).sortWithinPartitions("id")
    for table in (written, materialize(written, "t-numbered")):
        got = numbered(table, "t-numbered").select("doc.*", "position").orderBy("position").collect()
        assert [r.position for r in got] == list(range(1000)) and sum(a.id > b.id for a, b in zip(got, got[1:])) <= 4
    assert numbered(written.limit(0), "t-numbered").collect() == []


def test_near_copies_keeps_a_row_of_each_group_of_a_repeated_id(spark, docs_of, sf_dir):
    import corpus_pipeline as cp
    one, two, three = (" ".join(f"{w}{i}" for i in range(200)) for w in ("apple", "stone", "river"))
    docs = docs_of([(1, one), (1, two), (2, two), (2, three), (3, one), (3, three), (3, three), (None, one), (None, one)], parts=2)
    out = cp.near_copies(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted([(0, one), (0, one), (1, one), (1, two), (2, three)])
