"""Net change of each key over a stretch of a changelog (P21).

A chain of changes folds to its first and last change: what was there before
and what is there after decide the net operation (I-U-U is I, I-D is
nothing, U-D is D, D-I is U).  Changes that cannot follow one another (an
insert of a row that is there, an update or delete of one that is not) are
counted.  Summaries of neighbouring stretches combine in the same way, so a
chain is folded by position bucket first: a key with a third of all changes
is spread over the tasks, and only one row a key and bucket goes on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.operators.audit import _keys

OPS = ("I", "U", "D")


def _impossible(before: Column, op: Column) -> Column:
    """Whether ``op`` cannot follow the operation ``before``."""
    return F.when(before == "D", op != "I").otherwise(op == "I")


def chain_summaries(changes: DataFrame, key: str | Sequence[str], position: str, width: int = 1 << 16) -> DataFrame:
    """``changes(key..., position, op, before, after)`` -> one row a key and bucket of ``width`` positions:
    ``key..., bucket, lo, hi, first, last, n, impossible``.

    Changes with one key and position are one change delivered again (the least by op, before, after is taken).
    A row with a NULL key or position, or an operation other than I, U and D, is left out.
    """
    keys = _keys(key)
    rows = changes.select(*keys, F.col(position).cast("long").alias("_pos"), "op", "before", "after").where(F.col("op").isin(*OPS))
    for k in (*keys, "_pos"):
        rows = rows.where(F.col(k).isNotNull())
    # one exchange, which the repeats, the order and the fold of a bucket share
    rows = rows.withColumn("_bucket", F.expr(f"_pos div {width}")).repartition(*keys, "_bucket")
    once = rows.groupBy(*keys, "_bucket", "_pos").agg(F.min(F.struct("op", "before", "after")).alias("_c"))
    order = Window.partitionBy(*keys, "_bucket").orderBy("_pos")
    marked = once.withColumn("_before", F.lag("_c.op").over(order))
    wrong = F.coalesce(_impossible(F.col("_before"), F.col("_c.op")) & F.col("_before").isNotNull(), F.lit(False))
    return marked.withColumn("_wrong", wrong.cast("long")).groupBy(*keys, F.col("_bucket").alias("bucket")).agg(
        F.min("_pos").alias("lo"), F.max("_pos").alias("hi"), F.min_by("_c", "_pos").alias("first"), F.max_by("_c", "_pos").alias("last"),
        F.count(F.lit(1)).alias("n"), F.sum("_wrong").alias("impossible"))


def fold_summaries(summaries: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Summaries of stretches that do not overlap -> one a key (without ``bucket``).  The result can be kept and
    folded again with those of later stretches."""
    keys = _keys(key)
    order = Window.partitionBy(*keys).orderBy("lo")
    joint = summaries.withColumn("_before", F.lag("last.op").over(order))
    wrong = F.coalesce(_impossible(F.col("_before"), F.col("first.op")) & F.col("_before").isNotNull(), F.lit(False))
    return joint.withColumn("_wrong", wrong.cast("long")).groupBy(*keys).agg(
        F.min_by("first", "lo").alias("first"), F.max_by("last", "lo").alias("last"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.sum("n").alias("n"), F.sum(F.col("impossible") + F.col("_wrong")).alias("impossible"))


def net_of(folded: DataFrame, key: str | Sequence[str], keep_nothing: bool = False) -> DataFrame:
    """Folded chains -> ``key..., op, before, after, first_position, last_position, n_changes, n_impossible``.

    A chain that begins with an insert and ends with a delete changes nothing and is left out
    (with ``keep_nothing`` it stays, with a NULL ``op``)."""
    was, is_there = F.col("first.op") != "I", F.col("last.op") != "D"
    op = F.when(~was & is_there, F.lit("I")).when(was & is_there, F.lit("U")).when(was & ~is_there, F.lit("D"))
    out = folded.select(*_keys(key), op.alias("op"), F.when(was, F.col("first.before")).alias("before"),
                        F.when(is_there, F.col("last.after")).alias("after"), F.col("lo").alias("first_position"),
                        F.col("hi").alias("last_position"), F.col("n").alias("n_changes"), F.col("impossible").alias("n_impossible"))
    return out if keep_nothing else out.where("op is not null")


def net_changes(changes: DataFrame, key: str | Sequence[str], position: str, width: int = 1 << 16, keep_nothing: bool = False) -> DataFrame:
    """The net change of each key (see the functions above)."""
    return net_of(fold_summaries(chain_summaries(changes, key, position, width), key), key, keep_nothing)
