"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm.ann_search import adaptive_scan, exact_cosine, nearest_neighbours
from changelake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k=5):
    fit = [(i, np.array(v, np.float64)) for i, v in rows
           if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in queries:
        if q is None or not v or not all(x is not None and np.isfinite(x) for x in v) or not any(v):
            continue
        v = np.array(v, np.float64)
        near = sorted((-float(x @ v / np.sqrt((x @ x) * (v @ v))), i) for i, x in fit if i != q and len(x) == len(v))
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in best}) for q, best in want.items())
    return hits / sum(map(len, want.values()))


def floats(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def test_query_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    got = found(QUERIES["op11_ann_search"](spark, sf_dir))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert recall(got, want) >= 0.9
    score = {(q, i): s for q, best in brute(rows, [r for r in rows if r[0] % 50 == 0], len(rows)).items() for i, s in best}
    assert all(abs(score[q, i] - s) < 1e-12 for q, best in got.items() for i, s in best)


def test_clustered_and_uniform(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(40, 48))
    rows = [(i, floats(centres[i % 40] + 0.3 * rnd.normal(size=48))) for i in range(3000)]
    rows += [(3000 + i, floats(rnd.normal(size=48))) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    assert recall(found(nearest_neighbours(df, df.where("vec_id % 50 = 0"), sample_rows=1500)), want) >= 0.9


def test_hot_group_of_equal_vectors(spark, monkeypatch):
    """A third of the rows are one vector: ties go to the smallest ids, over many blocks."""
    from changelake.llm import ann_search
    monkeypatch.setattr(ann_search, "LIST_BLOCK", 64)
    monkeypatch.setattr(ann_search, "QUERY_BLOCK", 8)
    rnd = np.random.default_rng(4)
    same = floats(rnd.normal(size=20))
    rows = [(i, same if i % 3 == 0 else floats(rnd.normal(size=20))) for i in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(nearest_neighbours(df, df.where("vec_id % 50 = 0")))
    for q in range(0, 1200, 150):
        assert [i for i, _ in got[q]] == [i for i in range(0, 30, 3) if i != q][:5]
    assert recall(got, brute(rows, [r for r in rows if r[0] % 50 == 0])) >= 0.9


def test_odd_vectors(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, floats(rnd.normal(size=6))) for i in range(60)]
    rows += [(100, None), (150, []), (200, [0.0] * 6), (250, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (300, [float("nan")] * 6), (350, [float("inf")] * 6),
             (None, floats(rnd.normal(size=6))), (400, [1.0, 2.0]), (450, [2.0, 1.0]), (500, [3.0] * 9), (0, rows[0][1]), (7, rows[7][1]),
             (550, [1e38] * 6), (600, [1e-38] * 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "d", "list", "block", "n", "label", "query_id", "score", "rank"):
        df = df.withColumn(name, F.lit("x"))
    got = found(nearest_neighbours(df.dropDuplicates(["vec_id"]), df.where("vec_id % 50 = 0").dropDuplicates(["vec_id"])))
    once = list({i: (i, v) for i, v in rows}.values())
    want = brute(once, [r for r in once if r[0] is not None and r[0] % 50 == 0])
    assert {q: [i for i, _ in b] for q, b in got.items()} == {q: [i for i, _ in b] for q, b in want.items() if b}
    assert [i for i, _ in got[400]] == [450] and 500 not in got
    # a repeated row is a candidate again, a query's own rows are not
    twice = nearest_neighbours(df, df.where("vec_id = 50"), k=70)
    ids = [r["vec_id"] for r in twice.collect()]
    assert ids.count(7) == 2 and 50 not in ids
    assert nearest_neighbours(df.limit(0), df).collect() == [] and nearest_neighbours(df, df.limit(0)).collect() == []


def test_few_candidates_are_all_found(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, floats(rnd.normal(size=8))) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {q: len(b) for q, b in found(nearest_neighbours(df, df)).items()} == dict.fromkeys(range(4), 3)


def test_scan_gives_up_early_and_keeps_the_nearest():
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(4000, 128)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:110] = x[17] + 0.02 * rnd.normal(size=(10, 128)).astype(np.float32)
    q = x[17] + 0.01 * rnd.normal(size=128).astype(np.float32)
    read: list = []
    kept = adaptive_scan(q, [np.ascontiguousarray(x[:, a:a + 16]) for a in range(0, 128, 16)], 5, counted=read)
    assert 17 in kept and sum(read) < 0.5 * x.size
    best = np.argsort(((x - q) ** 2).sum(1))[:5]
    assert len(set(best) & set(kept)) >= 4


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e30])
def test_exact_cosine(scale):
    x = np.array([[3.0, 4.0], [4.0, 3.0]]) * scale
    assert exact_cosine(x[0], x).tolist() == pytest.approx([1.0, 0.96])
