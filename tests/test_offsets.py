"""Offset coverage against sets of numbers."""

import random

import pytest

from changelake.operators.offsets import committed_offsets, merge_ranges, offset_gaps, offset_ranges

SCHEMA = "topic string, partition int, offset long"


def runs(numbers):
    out = []
    for x in sorted(numbers):
        if out and x == out[-1][1] + 1:
            out[-1][1] = x
        else:
            out.append([x, x])
    return out


def sample():
    rnd = random.Random(2)
    rows = [("t", 0, o) for o in range(3, 2000) if o % 97 > 2 and not 500 <= o < 700] + [("t", 1, rnd.randrange(300)) for _ in range(200)]
    rows += [(None, 1, 5), (None, 1, 6), ("u", None, 1), ("u", 2, None), ("u", 2, 10)]
    return rows + rows[:100]


@pytest.mark.parametrize("width", [1, 13, 64, 1 << 20])
def test_ranges_gaps_and_committed(spark, width):
    rows = sample()
    ranges = offset_ranges(spark.createDataFrame(rows, SCHEMA).repartition(4), width)
    landed = {}
    for t, p, o in rows:
        if p is not None and o is not None:
            landed.setdefault((t, p), []).append(o)
    want = [(t, p, a, b, n := sum(a <= o <= b for o in os), n - (b - a + 1)) for (t, p), os in landed.items() for a, b in runs(set(os))]
    assert sorted(map(tuple, ranges.collect()), key=str) == sorted(want, key=str)
    gaps = [(t, p, a, b) for (t, p), os in landed.items() for a, b in runs(set(range(0, max(os))) - set(os))]
    assert sorted(map(tuple, offset_gaps(ranges, begin=0).collect()), key=str) == sorted(gaps, key=str)
    inner = [(t, p, a, b) for (t, p), os in landed.items() for a, b in runs(set(range(min(os), max(os))) - set(os))]
    assert sorted(map(tuple, offset_gaps(ranges).collect()), key=str) == sorted(inner, key=str)
    committed = {(t, p): (runs(set(os))[0][1] + 1 if min(os) <= 0 else 0) for (t, p), os in landed.items()}
    assert {(r["topic"], r["partition"]): r["committed"] for r in committed_offsets(ranges, begin=0).collect()} == committed


def test_kept_ranges_merge_with_new_ones(spark):
    rows = [r for r in sample() if r[1] is not None and r[2] is not None]
    whole = offset_ranges(spark.createDataFrame(rows, SCHEMA), 50)
    parts = [offset_ranges(spark.createDataFrame(rows[k::3], SCHEMA), 50) for k in range(3)]
    kept = parts[0]
    for part in parts[1:]:
        kept = merge_ranges(kept.unionByName(part).select("topic", "partition", "lo", "hi", "n_records").withColumnRenamed("n_records", "n"))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert offset_ranges(spark.createDataFrame([], SCHEMA)).collect() == []
