"""Mixing with many sources: against the registered SQL, and against a plain schedule beyond the period."""

import math
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from changelake.llm.mixing import FAN_OUT, components_of, mix_sources, quota_levels
from changelake.llm.oracle import MIX

COLUMNS = ["doc_id", "source", "component", "q", "block", "release", "deadline", "slot", "offset"]


def documents(n_sources, largest):
    """Source i has about largest / (i + 1) documents, one at least."""
    return [(i, f"s{k:05d}" if k else None) for i, k in enumerate(k for k in range(n_sources) for _ in range(1 + largest // (k + 1)))]


def test_300_sources_match_the_sql(spark, tmp_path):
    docs = spark.createDataFrame(documents(300, 400), "doc_id long, source string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in COLUMNS)} FROM ({MIX})").fetchall()
    got = mix_sources(docs).select("doc.doc_id", "doc.source", *COLUMNS[2:])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert got.select("component").distinct().count() == 300


def test_more_sources_than_slots(spark):
    rows = documents(90, 200)
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, source string"), period=64, block_rows=2, bucket_rows=100).collect()
    assert Counter((r.doc.doc_id, r.doc.source) for r in out) == Counter(rows)
    quota = {r.component: r.q for r in out}
    period = sum(quota.values())
    assert len(quota) == 90 == len({(r.component, r.doc.source) for r in out}) and period == 2048
    slots = earliest_deadline_first(quota, period)
    assert all(r.slot == r.block // r.q * period + slots[r.component, r.block % r.q] and r.release <= r.slot < r.deadline for r in out)


def earliest_deadline_first(quota, period):
    """(member, block) -> slot of one period, one member at a time."""
    done, slots = Counter(), {}
    for t in range(period):
        _, c = min((math.ceil((done[c] + 1) * period / q), c) for c, q in quota.items() if done[c] * period // q <= t)
        slots[c, done[c]] = t
        done[c] += 1
    return slots


def test_nodes_of_nodes(spark):
    """30 sources in nodes of 4: three levels, each block where a plain schedule of every node puts it."""
    rows = documents(30, 120)
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mix_sources(docs, period=16, block_rows=2, bucket_rows=40, fan_out=4).collect()
    assert Counter((r.doc.doc_id, r.doc.source) for r in out) == Counter(rows)
    parts = components_of(docs.groupBy("source").agg(F.count("*").alias("n")))
    levels = [level.collect() for level in quota_levels(parts, 30, 16, 4)]
    assert [len(level) for level in levels] == [30, 8, 2]
    quota = [{r.member: r.q for r in level} for level in levels]
    plans, periods = [], []
    for level in levels:
        nodes = {r.node for r in level}
        periods.append({r.member: r.period for r in level})
        plans.append({})
        for node in nodes:
            q = {r.member: r.q for r in level if r.node == node}
            plans[-1].update(earliest_deadline_first(q, sum(q.values())))
    above = [{r.member: r.node for r in level} for level in levels]
    share, run = {c: 1.0 for c in quota[0]}, Counter()
    for r in out:
        slot, member = r.block, r.component
        for q, plan, period, node in zip(quota, plans, periods, above):
            slot, member = slot // q[member] * period[member] + plan[member, slot % q[member]], node[member]
        assert r.slot == slot and r.release <= slot < r.deadline
    for c in share:
        member = c
        for q, period, node in zip(quota, periods, above):
            share[c], member = share[c] * q[member] / period[member], node[member]
    blocks = {(r.slot, r.component) for r in out}
    assert len(blocks) == len({s for s, _ in blocks})
    last = {c: max(s for s, d in blocks if d == c) for c in share}
    at = dict(blocks)
    for t in range(min(last.values()) + 1):
        run.update([at[t]] if t in at else [])
        assert all(abs(run[c] - (t + 1) * share[c]) < 3 for c in share)


def shares(spark, weights):
    """By component: its share of all slots, and what one slot of its own node is of them."""
    parts = spark.createDataFrame(list(enumerate(weights)), "component long, w long")
    levels = [{r.member: r for r in level.collect()} for level in quota_levels(parts, len(weights))]
    out = []
    for c in range(len(weights)):
        r = levels[0][c]
        slot = 1 / r.period
        for level in levels[1:]:
            slot *= level[r.node].q / level[r.node].period
            r = level[r.node]
        out.append((levels[0][c].q * slot, slot))
    return out


def test_shares_follow_the_weights_at_every_size(spark):
    """Counts of 1/rank with their roots as weights, 1 to 100,000 sources: within a slot, and 1.5 % for the levels above."""
    for n in (1, 20, 900, 1024, 1025, 100_000):
        weights = [int(math.sqrt(max(1, 10**9 // (i + 1))) * 1024) for i in range(n)]
        got, total = shares(spark, weights), sum(weights)
        assert abs(sum(g for g, _ in got) - 1) < 1e-9
        above = 0.015 if n > FAN_OUT else 1e-9
        assert all(abs(g - w / total) <= slot + above * w / total for (g, slot), w in zip(got, weights)), n


def test_steep_weights_keep_their_shares(spark):
    for n in (900, 1024, 1025):
        weights = [1_000_000 // (i + 1) for i in range(n)]
        got, total = shares(spark, weights), sum(weights)
        assert abs(got[0][0] - weights[0] / total) < 0.002
    # 1,000 sources of next to no weight take their one slot each, 1/16 of the period at most
    got = [g for g, _ in shares(spark, [10**9] + [1] * 1000)]
    assert got[0] >= 15 / 16 and min(got) > 0
