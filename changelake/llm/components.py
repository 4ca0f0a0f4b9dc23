"""Connected components by alternating large-star and small-star steps.

Edges live in written tables; each round reads the last one and writes the
next, so nothing but a two-number convergence test reaches the driver.  A
vertex with very many edges is a hub: its edges are dealt to several keys, to
each of which its least neighbour is copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import materialize

MAX_ROUNDS = 64
# A hub has more edges than this, and than a MAX_HUBS-th of all.
HUB_EDGES = 256
MAX_HUBS = 1024


def _with_least(pairs: DataFrame, n: int) -> DataFrame:
    """``pairs(a, b)``, at most 2n rows -> ``(a, b, m, part)``, m the least b of the row's a, part its share of a hub."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    share = max(HUB_EDGES, 2 * n // MAX_HUBS)
    # at most MAX_HUBS vertices have more than a MAX_HUBS-th of the pairs
    hubs = F.broadcast(least.where(F.col("degree") > share).select("a", F.ceil(F.col("degree") / share).alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    dealt = pairs.join(hubs, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("part"))
    copies = least.join(hubs, "a", "left").select("a", "m", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    return dealt.join(copies, ["a", "part"]).select("a", "b", "m", "part")


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both, n).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = _with_least(edges, n).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(a, b)`` of longs -> ``(v, root)``: each vertex that has an edge
    and the smallest vertex of its component (the root itself included)."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, name)
    seen = None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
        if not state[0]:
            break
        edges = materialize(_small_star(_large_star(edges, state[0]), state[0]), name)
    else:
        raise RuntimeError(f"components did not converge in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("v")).distinct().select("v", F.col("v").alias("root"))
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")).unionAll(roots)
