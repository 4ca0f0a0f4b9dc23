"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

Each source is a component with a weight of q slots in a period of Q (the
weights sum to Q).  Its documents, in a hashed order, are cut into blocks;
block i may not run before its release floor(i*Q/q) and must run by its
deadline ceil((i+1)*Q/q).  One block runs per slot: of the released blocks
the one with the earliest deadline (ties: the lower component).  Every
deadline is met, so after any t slots each component that still has blocks
has run within one block of t*q/Q.

Components are numbered by falling document count and dealt in turn to the
least number of nodes with at most ``FAN_OUT`` members each; nodes are dealt to
nodes again, up to a single root, at every size by the same rule.  A node is
scheduled among its siblings as a source is among the sources of its node.  A
node's period is the least power of two times ``PERIOD`` with ``SLOTS_EACH``
slots a member (for nodes of nodes, with as many as a full node has), so that
quotas follow the weights however many sources there are.  Where several levels are
needed, a source deviates by less than one block in its own node, and by its
share of the node times less than one block for each level above.

A node's schedule repeats every Q slots, so it is folded once over one period
(a row a node, at most 2 * SLOTS_EACH * FAN_OUT slots) and every block's slot
follows from its number.  Members of equal q have equal windows and take
turns, so the fold holds one entry for each distinct q, of which there are
fewer than sqrt(2Q).  A component that has no blocks left leaves its slots
empty; reading in (slot, offset) order then interleaves the others in their
proportions.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm.common import materialize, numbered

PERIOD = 1024
SLOTS_EACH = 16
FAN_OUT = 1024
BLOCK_ROWS = 64
BUCKET_ROWS = 8192
FOLD_SLOTS = 512
BROADCAST_ROWS = 200_000


def _targets(counts: DataFrame, weights: dict[str, float] | None, max_components: int | None) -> DataFrame:
    """``counts(source, n)`` -> named components ``(source, n, w)``: all sources (or the largest, where the
    caller bounds them) with weight sqrt(n), or the sources that ``weights`` names."""
    if weights is None:
        if max_components is not None:
            counts = counts.orderBy(F.desc("n"), F.asc_nulls_last("source")).limit(max_components - 1)
        return counts.withColumn("w", _root_weight("n"))
    given = F.create_map(*[x for s, w in weights.items() for x in (F.lit(s), F.lit(max(1, round(w * 1_000_000))).cast("long"))])
    return (counts.where(F.col("source").isin(list(weights)))
            .withColumn("w", F.element_at(given, F.col("source"))))


def _root_weight(n: str) -> Column:
    return F.floor(F.sqrt(F.col(n).cast("double")) * 1024).cast("long")


def components_of(counts: DataFrame, weights: dict[str, float] | None = None, other_weight: float | None = None,
                  max_components: int | None = None) -> DataFrame:
    """``counts(source, n)`` -> ``(component, source, is_other, w)``.

    Components are numbered by falling document count, then by name; all
    sources that are not named share the last one.
    """
    named = _targets(counts, weights, max_components)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_n"))
    inside = named.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("named_n"))
    rest = (totals.join(inside).select((F.col("all_n") - F.col("named_n")).alias("n")).where("n > 0")
            .select(F.lit(None).cast("string").alias("source"), "n",
                    (_root_weight("n") if other_weight is None
                     else F.lit(max(1, round(other_weight * 1_000_000))).cast("long")).alias("w"),
                    F.lit(True).alias("is_other")))
    all_of = named.withColumn("is_other", F.lit(False)).unionByName(rest)
    ordered = numbered(all_of.orderBy("is_other", F.desc("n"), F.asc_nulls_last("source")), "mixing-components")
    return ordered.select(F.col("position").alias("component"), "doc.source", "doc.is_other", "doc.w")


def quotas(members: DataFrame, period: int = PERIOD) -> DataFrame:
    """``members(node, member, w)`` -> the same with ``q`` and ``period``; a node's q sum to its period.

    Each member has a slot; the others go by largest remainder (ties: the
    lower member) in proportion to what a member's exact share w/sum(w) of
    the period has beyond one slot.  So q is within a slot of the exact share,
    unless members below one slot take theirs: then the others lose at most
    1/SLOTS_EACH of their share.
    """
    whole = Window.partitionBy("node")
    times = f"((c * {SLOTS_EACH} + {period - 1}) div {period})"
    shares = (members.withColumn("w", F.col("w").cast("decimal(38,0)"))
              .withColumn("c", F.count("*").over(whole)).withColumn("sum_w", F.sum("w").over(whole))
              .withColumn("period", F.expr(f"{period}L * IF({times} <= 1, 1L, shiftleft(1L, length(bin({times} - 1))))"))
              .withColumn("beyond", F.expr("greatest(cast(period * w - sum_w as decimal(38,0)), cast(0 as decimal(38,0)))"))
              .withColumn("all_beyond", F.sum("beyond").over(whole))
              .withColumn("num", F.expr("cast((period - c) * beyond as decimal(38,0))"))
              .withColumn("base", F.expr("1 + num div all_beyond")).withColumn("left_over", F.expr("num % all_beyond")))
    by_rest = Window.partitionBy("node").orderBy(F.desc("left_over"), "member")
    return (shares.withColumn("spare", F.col("period") - F.sum("base").over(whole))
            .withColumn("q", F.col("base") + F.when(F.row_number().over(by_rest) <= F.col("spare"), 1).otherwise(0))
            .select("node", "member", "w", F.col("q").cast("long"), "period"))


def quota_levels(components: DataFrame, count: int, period: int = PERIOD, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Quotas of the ``count`` components in their nodes, of these nodes in theirs, up to the root."""
    level, levels = components.select(F.col("component").alias("member"), "w"), []
    while True:
        nodes = max(1, -(-count // fan_out))
        levels.append(materialize(quotas(level.select((F.col("member") % nodes).alias("node"), "member", "w"), period), "mixing-quotas"))
        if nodes == 1:
            return levels
        level = levels[-1].groupBy(F.col("node").alias("member")).agg(F.sum("w").alias("w"))
        count, period = nodes, max(period, SLOTS_EACH * fan_out)


def period_schedule(quota: DataFrame) -> DataFrame:
    """Earliest-deadline-first over one period of each node: ``(member, j, slot_in_period)`` for block j of each period."""
    alike = quota.groupBy("node", "period", "q").agg(F.array_sort(F.collect_list("member")).alias("members"))
    nodes = alike.groupBy("node", "period").agg(F.array_sort(F.collect_list(F.struct("q", "members"))).alias("k"))
    # entry i has run done[i] blocks: its members in turn, block done[i] div members of each
    step = """
        transform(array(array_min(filter(
              transform(k, (x, i) -> IF((u.done[i] div size(x.members)) * period div x.q <= t,
                  named_struct('deadline', ((u.done[i] div size(x.members) + 1) * period + x.q - 1) div x.q,
                               'member', x.members[cast(u.done[i] % size(x.members) as int)], 'i', i), NULL)),
              y -> y IS NOT NULL))),
            pick -> named_struct('done', transform(u.done, (d, i) -> IF(i = pick.i, d + 1, d)),
                                 'slots', array_append(u.slots, pick.member)))[0]"""
    fold = f"""
        aggregate(sequence(0L, (period - 1) div {FOLD_SLOTS}),
          named_struct('done', transform(k, x -> 0L), 'parts', cast(array() as array<array<bigint>>)),
          (s, c) -> transform(array(aggregate(sequence(c * {FOLD_SLOTS}, least((c + 1) * {FOLD_SLOTS}, period) - 1),
              named_struct('done', s.done, 'slots', cast(array() as array<bigint>)), (u, t) -> {step})),
            r -> named_struct('done', r.done, 'parts', array_append(s.parts, r.slots)))[0],
          s -> flatten(s.parts))"""
    slots = nodes.select(F.posexplode(F.expr(fold)).alias("slot_in_period", "member"))
    nth = Window.partitionBy("member").orderBy("slot_in_period")
    return slots.select("member", (F.row_number().over(nth) - 1).cast("long").alias("j"), F.col("slot_in_period").cast("long"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, other_weight: float | None = None,
                period: int = PERIOD, block_rows: int = BLOCK_ROWS, max_components: int | None = None,
                bucket_rows: int = BUCKET_ROWS, fan_out: int = FAN_OUT) -> DataFrame:
    """``docs(doc_id, source, ...)`` -> ``(doc, component, q, block, release, deadline, slot, offset)``.

    ``doc`` is the input row as a struct, so its columns may have any name.
    Every row is kept once; (slot, offset) is the mixture's order.

    * without ``weights`` the target weight of a source is the root of its
      document count; with it, the named sources have the given weights and
      the others share ``other_weight`` (None: the root of their count);
    * every source is a component of its own, unless the caller gives ``max_components``: then
      beyond ``max_components - 1`` sources the smaller ones share one;
    * a period is doubled from ``period`` until it has 16 slots a member; with more than ``fan_out``
      components, q counts in the period of the component's node, and release, deadline and slot in the root's slots;
    * NULL is a source like any other;
    * within a source the order is md5(doc_id as text), then doc_id (NULL as
      empty text); repeated rows stay, next to each other;
    * an empty table gives an empty result.
    """
    if max_components is not None and len(weights or ()) >= max_components:
        raise ValueError("max_components must exceed the number of weights")
    counts = materialize(docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n")), "mixing-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = materialize(components_of(counts, weights, other_weight, max_components), "mixing-weights")
    count = parts.count()
    levels = quota_levels(parts, count, period, fan_out)
    # more slots than the periods of a level together can have
    slots = 2 * (SLOTS_EACH * (count + fan_out) + period * (1 + count // fan_out))
    small = F.broadcast if slots <= BROADCAST_ROWS else lambda df: df
    buckets = max(1, -(-total // bucket_rows))
    named = small(parts.where("not is_other").select(F.col("source").alias("named"), "component"))
    other = F.broadcast(parts.where("is_other").agg(F.max("component").alias("other")))
    digest = F.md5(F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = (docs.select(F.struct("*").alias("doc"))
            .withColumn("digest", digest)
            .withColumn("bucket", F.expr(f"cast(conv(substr(digest, 1, 8), 16, 10) as bigint) * {buckets} div 4294967296"))
            .join(named, F.col("doc.source").cast("string").eqNullSafe(F.col("named")), "left").join(other)
            .withColumn("component", F.coalesce("component", "other")).drop("named", "other"))
    place = ["component", "bucket"]
    sizes = rows.groupBy(*place).agg(F.count("*").alias("n"))
    before = Window.partitionBy("component").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*place, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*place).orderBy("digest", "doc.doc_id")
    placed = (rows.withColumn("rn", F.row_number().over(inside) - 1).drop("digest")
              .join(starts, place)
              .withColumn("rn", F.col("rn") + F.col("start"))
              .withColumn("block", F.expr(f"rn div {block_rows}"))
              .select("doc", "component", "block", F.expr(f"rn % {block_rows}").alias("offset"), F.col("component").alias("member"),
                      F.col("block").alias("release"), (F.col("block") + 1).alias("deadline"), F.col("block").alias("slot"),
                      F.lit(None).cast("long").alias("q")))
    for level in levels:
        placed = (placed.join(small(level.select("member", "node", F.col("q").alias("own"), "period")), "member")
                  .withColumn("j", F.expr("slot % own"))
                  .join(small(period_schedule(level)), ["member", "j"])
                  .select("doc", "component", "block", "offset", F.col("node").alias("member"),
                          F.expr("release * period div own").alias("release"),
                          F.expr("(deadline * period + own - 1) div own").alias("deadline"),
                          F.expr("(slot div own) * period + slot_in_period").alias("slot"),
                          F.coalesce("q", "own").alias("q")))
    return placed.select("doc", "component", "q", "block", "release", "deadline", "slot", "offset")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, in the mixture's order."""
    return mix_sources(docs, **options).orderBy("slot", "offset").select("doc.*")
