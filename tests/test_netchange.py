"""Net change of keys against a fold in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators.netchange import chain_summaries, fold_summaries, net_changes, net_of

SCHEMA = "k string, j int, pos long, op string, before string, after string"
COLUMNS = ["k", "j", "op", "before", "after", "first_position", "last_position", "n_changes", "n_impossible"]


def brute(rows, keep=False):
    chains = {}
    for k, j, pos, op, before, after in rows:
        if k is None or j is None or pos is None or op not in ("I", "U", "D"):
            continue
        chains.setdefault((k, j), {}).setdefault(pos, []).append((op, before, after))
    out = []
    for key, chain in chains.items():
        steps = [(pos, *min(chain[pos], key=lambda c: tuple((v is not None, v or "") for v in c))) for pos in sorted(chain)]
        wrong = sum((a[1] == "D") != (b[1] == "I") for a, b in zip(steps, steps[1:]))
        was, there = steps[0][1] != "I", steps[-1][1] != "D"
        op = {(False, True): "I", (True, True): "U", (True, False): "D"}.get((was, there))
        if op or keep:
            out.append((*key, op, steps[0][2] if was else None, steps[-1][3] if there else None, steps[0][0], steps[-1][0], len(steps), wrong))
    return sorted(out, key=str)


def sample(n=900, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])
        rows.append((k, rnd.choice([1, 1, 2]), rnd.choice([i, i, -i, None]) if i % 50 == 0 else i - 200, rnd.choice("IUUD"),
                     rnd.choice([None, f"b{i}"]), rnd.choice([None, f"a{i}"])))
    return rows + rows[:40] + [("x", 1, 5, "?", None, None), ("x", 1, 6, None, None, None)]


@pytest.mark.parametrize("width", [7, 1 << 20])
@pytest.mark.parametrize("keep", [False, True])
def test_against_a_plain_fold(spark, width, keep):
    rows = sample()
    out = net_changes(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k", "j"], "pos", width, keep)
    assert sorted(map(tuple, out.select(*COLUMNS).collect()), key=str) == brute(rows, keep)


@pytest.mark.parametrize("ops, net, wrong", [
    ("IUU", "I", 0), ("ID", None, 0), ("UD", "D", 0), ("DI", "U", 0), ("U", "U", 0), ("IDI", "I", 0), ("II", "I", 1), ("DU", "U", 1), ("DD", "D", 1)])
def test_rules(spark, ops, net, wrong):
    rows = [("a", 1, i, op, f"b{i}", f"a{i}") for i, op in enumerate(ops)]
    for width in (1, 100):
        got = net_changes(spark.createDataFrame(rows, SCHEMA), ["k", "j"], "pos", width, keep_nothing=True).first()
        assert (got["op"], got["n_impossible"], got["n_changes"]) == (net, wrong, len(ops))


def test_kept_folds_combine_with_later_stretches(spark):
    rows = [r for r in sample() if r[2] is not None]
    parts = [spark.createDataFrame([r for r in rows if lo <= r[2] < hi], SCHEMA) for lo, hi in ((-10_000, 0), (0, 300), (300, 10_000))]
    kept = None
    for part in parts:
        fresh = chain_summaries(part, ["k", "j"], "pos", 11).drop("bucket")
        kept = fold_summaries(fresh if kept is None else kept.unionByName(fresh), ["k", "j"])
    assert sorted(map(tuple, net_of(kept, ["k", "j"]).select(*COLUMNS).collect()), key=str) == brute(rows)


def test_hot_key_is_folded_in_buckets(spark):
    rows = spark.range(30_000).select(F.lit("hot").alias("k"), F.col("id").alias("pos"), F.lit("U").alias("op"),
                                      F.col("id").cast("string").alias("before"), F.col("id").cast("string").alias("after"))
    assert chain_summaries(rows, "k", "pos", 1000).agg(F.count("*"), F.max("n")).first() == (30, 1000)
    assert net_changes(rows, "k", "pos", 1000).first()["after"] == "29999"


def test_empty(spark):
    assert net_changes(spark.createDataFrame([], SCHEMA), ["k", "j"], "pos").collect() == []
