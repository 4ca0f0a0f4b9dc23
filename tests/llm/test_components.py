"""Connected components against union-find, hubs included."""

import random

import pytest

from changelake.llm import components
from changelake.llm.components import connected_components


def brute(edges):
    root = {}

    def find(v):
        root.setdefault(v, v)
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((v, find(v)) for v in root)


RND = random.Random(5)
GRAPHS = {
    "empty": [],
    "loops": [(3, 3), (4, 4)],
    "random": [(RND.randrange(400), RND.randrange(400)) for _ in range(250)],
    "repeated": [(1, 2), (2, 1), (1, 2), (-5, 2), (9, 9)],
    "least is the hub": [(0, i) for i in range(1, 900)] + [(5000, 5001)],
    "greatest is the hub": [(10_000, i) for i in range(900)] + [(20_000, 10_000)],
    "hub in the middle": [(500, i) for i in range(1000)],
    "hubs in a chain": [(1000 * h, 1000 * h + i) for h in range(5) for i in range(1, 300)] + [(1000 * h, 1000 * h + 1000) for h in range(4)],
    "path": [(i, i + 1) for i in range(60)],
}


@pytest.mark.parametrize("hub", [256, 16])
@pytest.mark.parametrize("name", GRAPHS)
def test_against_union_find(spark, monkeypatch, name, hub):
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    edges = spark.createDataFrame(GRAPHS[name], "a long, b long")
    assert sorted(map(tuple, connected_components(edges).collect())) == brute(GRAPHS[name])


@pytest.mark.parametrize("hub_at", [0, 10_000])
def test_a_hub_is_dealt_to_many_keys(spark, monkeypatch, hub_at):
    monkeypatch.setattr(components, "HUB_EDGES", 16)
    pairs = spark.createDataFrame([(hub_at, i) for i in range(1, 2001)], "a long, b long")
    dealt = components._with_least(pairs, 2000)
    assert {(r.a, r.m) for r in dealt.select("a", "m").collect()} == {(hub_at, 1)} and dealt.count() == 2000
    # 16 edges a key on average
    shares = [r["count"] for r in dealt.groupBy("a", "part").count().collect()]
    assert len(shares) > 100 and max(shares) < 48
