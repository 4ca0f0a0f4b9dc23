"""Capture by range digests (J3): find the key ranges that differ, join those alone.

A version of a table is summarised by a digest tree.  A leaf is a range of
``width`` keys (of a single integer key) or a bucket of key hashes (of any
other key); a node above covers ``fanout`` nodes below.  A node's digest is
the number of its rows and two 64-bit sums without carry of row hashes, so it
follows from its children, in any order, and one aggregation with map-side
partial sums makes the leaves: no row is shuffled.

Two versions are compared from the root down, and a node's children are read
only where it differs.  The old version's tree can be kept from its own
capture, so that only the new version is read whole.  The ranges that differ
reach both scans as filters on the key and as a semi-join on the leaf; all
other rows stay out of the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.audit import _keys, capture_changes
from changelake.operators.joins import checked_broadcast
from changelake.sinks.lake import remove_path

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGEST = ("rows", "one", "two")
DIGEST_SCHEMA = "level int, node long, rows long, one long, two long, shape string"
# Ranges of a pushed filter; more are joined to their nearest neighbours (the semi-join stays exact).
MAX_INTERVALS = 200
MAX_LEVELS = 16


def _div(number: str, by: int) -> Column:
    """Division rounded down, exact for longs."""
    return F.expr(f"{number} div {by} - if({number} < 0 and {number} % {by} <> 0, 1, 0)")


@dataclass(frozen=True)
class TreeShape:
    """How keys fall into leaves and leaves into nodes.  Trees compare only if their shapes are equal."""

    key: tuple[str, ...]
    width: int = 4096
    buckets: int = 0  # 0: ranges of an integer key; else buckets of key hashes
    fanout: int = 64

    @classmethod
    def of(cls, df: DataFrame, key: str | Sequence[str], width: int = 4096, buckets: int = 1 << 16, fanout: int = 64) -> TreeShape:
        """Ranges for a single integer key, else buckets."""
        keys = _keys(key)
        ranged = len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, INTEGERS)
        return cls(tuple(keys), width, 0 if ranged else buckets, fanout)

    def leaf(self) -> Column:
        if self.buckets:
            return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets))
        return _div(f"CAST(`{self.key[0]}` AS BIGINT)", self.width)

    def intervals(self, leaves: Sequence[int]) -> list[tuple[int, int]]:
        """First and last key of runs of leaves, at most ``MAX_INTERVALS`` after the nearest were joined."""
        runs: list[list[int]] = []
        for leaf in sorted(leaves):
            if runs and leaf == runs[-1][1] + 1:
                runs[-1][1] = leaf
            else:
                runs.append([leaf, leaf])
        if len(runs) > MAX_INTERVALS:
            gaps = sorted(range(1, len(runs)), key=lambda i: runs[i][0] - runs[i - 1][1])
            joined = set(gaps[:len(runs) - MAX_INTERVALS])
            kept: list[list[int]] = []
            for i, run in enumerate(runs):
                if i in joined:
                    kept[-1][1] = run[1]
                else:
                    kept.append(run)
            runs = kept
        return [(a * self.width, (b + 1) * self.width - 1) for a, b in runs]

    def text(self, df: DataFrame) -> str:
        """The shape and the columns with their types: digests of other columns or types say nothing about equality."""
        cols = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
        return f"{','.join(self.key)}|{self.width}|{self.buckets}|{self.fanout}|{cols}"


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of a row that tells NULLs of different columns apart."""
    cols = sorted(df.columns)
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols], *[F.col(f"`{c}`").isNull() for c in cols])


def leaf_digests(df: DataFrame, shape: TreeShape) -> DataFrame:
    """``(node, rows, one, two)`` of each leaf that has rows.  A NULL key is in the leaf of NULL."""
    hashed = df.select(shape.leaf().alias("node"), _row_hash(df, 1).alias("h1"), _row_hash(df, 2).alias("h2"))
    return hashed.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h1").alias("one"), F.bit_xor("h2").alias("two"))


def _above(nodes: DataFrame, fanout: int) -> DataFrame:
    return nodes.groupBy(_div("node", fanout).alias("node")).agg(
        F.sum("rows").alias("rows"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"))


def write_digests(df: DataFrame, shape: TreeShape, path: str) -> None:
    """Write the digest tree of a version: one folder a level, leaves (level 0) sorted by node.

    What was at ``path`` goes first: levels of another version would hide differences."""
    remove_path(df.sparkSession, path)
    spark, text = df.sparkSession, shape.text(df)
    nodes, level = leaf_digests(df, shape), 0
    while True:
        at = f"{path.rstrip('/')}/level={level}"
        (nodes.withColumn("shape", F.lit(text)).repartitionByRange("node").sortWithinPartitions("node").write.mode("overwrite").parquet(at))
        nodes = spark.read.schema("node long, rows long, one long, two long").parquet(at)
        if level == MAX_LEVELS or nodes.agg(F.count(F.lit(1))).first()[0] <= shape.fanout:
            break
        nodes, level = _above(nodes, shape.fanout), level + 1


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """A written digest tree."""
    return spark.read.option("basePath", path).schema(DIGEST_SCHEMA).parquet(path)


def _unlike(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes of one level that only one side has, or with different digests."""
    o = old.select(F.col("node").alias("old_node"), F.struct(*DIGEST).alias("o"))
    n = new.select(F.col("node").alias("new_node"), F.struct(*DIGEST).alias("n"))
    # a NULL key's leaf has a NULL node, which an equality would not match
    joined = o.join(n, F.col("old_node").eqNullSafe(F.col("new_node")), "full_outer")
    return joined.where(~F.col("o").eqNullSafe(F.col("n"))).select(F.coalesce("old_node", "new_node").alias("node"))


def unequal_leaves(old: DataFrame, new: DataFrame, shape: TreeShape) -> DataFrame:
    """``(node)`` of the leaves that differ between two written trees of one shape, found from the root down."""
    tops = [t.agg(F.max("level")).first()[0] for t in (old, new)]
    if None in tops:
        # an empty version: every leaf of the other one
        return _unlike(old.where("level = 0"), new.where("level = 0"))
    found = None
    for level in range(min(tops), -1, -1):
        sides = [t.where(F.col("level") == level) for t in (old, new)]
        if found is not None:
            parent = found.select(F.col("node").alias("parent"))
            sides = [t.join(parent, _div("node", shape.fanout).eqNullSafe(F.col("parent")), "left_semi") for t in sides]
        found = _unlike(*sides)
    return found


def _within(df: DataFrame, shape: TreeShape, leaves: DataFrame, listed: list[int | None] | None) -> DataFrame:
    """Rows in the leaves; with a short list of them, the key's ranges reach the scan."""
    if listed is not None and not shape.buckets:
        key = F.col(shape.key[0])
        parts = [key.between(a, b) for a, b in shape.intervals([x for x in listed if x is not None])]
        if None in listed:
            parts.append(key.isNull())
        df = df.where(reduce(or_, parts, F.lit(False)))
    node = F.col("_leaf").eqNullSafe(F.col("node"))
    return df.withColumn("_leaf", shape.leaf()).join(leaves, node, "left_semi").drop("_leaf")


def capture_by_ranges(old: DataFrame, new: DataFrame, key: str | Sequence[str], old_digests: str, new_digests: str,
                      shape: TreeShape | None = None, max_listed: int = 100_000, **kw) -> DataFrame:
    """The audit rows of :func:`capture_changes`, from the key ranges that differ.

    ``old_digests`` and ``new_digests`` are folders of written trees; the new
    one is written here, the old one only if it is missing or was made for
    another shape, other columns or types.  With at most ``max_listed``
    unequal leaves of an integer key their ranges are pushed to both scans.

    Rows that differ are taken for equal only if both 64-bit hash sums and the
    row count of their leaf agree.  The key check of ``capture_changes`` (for
    which see ``validate_key``) covers the ranges that are joined.
    """
    spark = new.sparkSession
    shape = shape or TreeShape.of(new, key)
    write_digests(new, shape, new_digests)
    if not _kept(spark, old_digests, shape.text(old)):
        write_digests(old, shape, old_digests)
    if shape.text(old) != shape.text(new):
        return capture_changes(old, new, key, **kw)
    leaves_at = f"{new_digests.rstrip('/')}_unequal"
    unequal_leaves(read_digests(spark, old_digests), read_digests(spark, new_digests), shape).write.mode("overwrite").parquet(leaves_at)
    leaves = spark.read.schema("node long").parquet(leaves_at)
    some = [r["node"] for r in leaves.limit(max_listed + 1).collect()]  # one number a range
    listed = some if len(some) <= max_listed else None
    near = checked_broadcast(leaves)
    return capture_changes(_within(old, shape, near, listed), _within(new, shape, near, listed), key, **kw)


def _kept(spark: SparkSession, path: str, text: str) -> bool:
    """Whether a tree of this shape is there (an empty version has none to tell)."""
    try:
        first = read_digests(spark, path).select("shape").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return first is not None and first["shape"] == text
