"""Capture by range digests against the whole join."""

import pytest
from pyspark.sql import functions as F

from changelake.operators import digests
from changelake.operators.audit import capture_changes
from changelake.operators.digests import (
    TreeShape, capture_by_ranges, leaf_digests, read_digests, unequal_leaves, write_digests,
)

KW = dict(db_name="d", table_name="t", version="v")


def version(spark, n=20_000):
    return spark.range(-n // 2, n // 2).select(F.col("id").alias("k"), (F.col("id") % 97).cast("string").alias("a"),
                                               F.when(F.col("id") % 5 != 0, F.col("id") * 2).alias("b"))


def changed(df):
    """A hot range (every row of one range), one single row far away, one row gone and one new."""
    return (df.withColumn("a", F.when(F.col("k").between(512, 767) | (F.col("k") == -9_000), F.lit("x")).otherwise(F.col("a")))
            .where("k <> 5000").unionByName(df.where("k = 1").withColumn("k", F.lit(900_000).cast("long"))))


def rows(df):
    return sorted(map(tuple, df.select("audit_log_id", "record_id", "operation", "old_data", "new_data").collect()))


@pytest.mark.parametrize("buckets", [0, 64])
def test_equal_to_the_whole_join(spark, tmp_path, buckets):
    old = version(spark)
    new = changed(old)
    shape = TreeShape(("k",), width=256, buckets=buckets, fanout=4)
    got = capture_by_ranges(old, new, "k", f"{tmp_path}/old", f"{tmp_path}/new", shape, **KW)
    assert rows(got) == rows(capture_changes(old, new, "k", **KW)) and len(rows(got)) == 259


def test_only_unequal_ranges_are_found_and_joined(spark, tmp_path):
    old = version(spark)
    old.write.parquet(f"{tmp_path}/o")
    changed(old).write.parquet(f"{tmp_path}/n")
    old, new = (spark.read.parquet(f"{tmp_path}/{x}") for x in "on")
    shape = TreeShape.of(new, "k", width=256, fanout=4)
    for name, df in (("old", old), ("new", new)):
        write_digests(df, shape, f"{tmp_path}/{name}")
    found = unequal_leaves(read_digests(spark, f"{tmp_path}/old"), read_digests(spark, f"{tmp_path}/new"), shape)
    assert sorted(r["node"] for r in found.collect()) == [-36, 2, 19, 900_000 // 256]
    out = capture_by_ranges(old, new, "k", f"{tmp_path}/old", f"{tmp_path}/new", shape, **KW)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [Or(") == 2 and "LessThanOrEqual(k,-8961)" in plan
    leaves = spark.createDataFrame([(x,) for x in (-36, 2, 19, 3515)], "node long")
    joined = digests._within(old, shape, leaves, [-36, 2, 19, 3515])
    assert joined.count() == 3 * 256


def test_levels_follow_from_their_children(spark, tmp_path):
    df = version(spark, 5000)
    shape = TreeShape(("k",), width=64, fanout=3)
    write_digests(df, shape, f"{tmp_path}/t")
    tree = {(r["level"], r["node"]): (r["rows"], r["one"], r["two"]) for r in read_digests(spark, f"{tmp_path}/t").collect()}
    for (level, node), (n, one, two) in tree.items():
        if level:
            below = [tree[level - 1, node * 3 + i] for i in range(3) if (level - 1, node * 3 + i) in tree]
            x = y = 0
            for b in below:
                x, y = x ^ b[1], y ^ b[2]
            assert (sum(b[0] for b in below), x, y) == (n, one, two)
    top = max(level for level, _ in tree)
    assert sum(v[0] for (level, _), v in tree.items() if level == top) == 5000 and sum(level == top for level, _ in tree) <= 3


def test_nulls_in_different_columns_differ(spark):
    shape = TreeShape(("k",), width=8)
    one = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    other = spark.createDataFrame([(1, "x", None)], "k int, a string, b string")
    assert leaf_digests(one, shape).collect() != leaf_digests(other, shape).collect()


def test_empty_versions_and_changed_columns(spark, tmp_path):
    old = version(spark, 600)
    shape = TreeShape.of(old, "k", width=64)
    none = old.limit(0)
    for a, b, n in ((none, old, 600), (old, none, 600), (none, none, 0), (old, old, 0)):
        root = f"{tmp_path}/{n}-{a is none}-{b is none}"
        assert len(rows(capture_by_ranges(a, b, "k", f"{root}/a", f"{root}/b", shape, **KW))) == n
    wider = old.withColumn("c", F.lit(1))
    got = capture_by_ranges(old, wider, "k", f"{tmp_path}/x", f"{tmp_path}/y", shape, **KW)
    assert rows(got) == rows(capture_changes(old, wider, "k", **KW))


def test_kept_tree_is_used_and_one_of_other_columns_is_not(spark, tmp_path):
    old = version(spark, 600)
    shape = TreeShape.of(old, "k", width=64)
    write_digests(old, shape, f"{tmp_path}/old")
    before = sorted(p.name for p in (tmp_path / "old" / "level=0").iterdir())
    new = changed(old)
    capture_by_ranges(old, new, "k", f"{tmp_path}/old", f"{tmp_path}/new", shape, **KW)
    assert sorted(p.name for p in (tmp_path / "old" / "level=0").iterdir()) == before
    write_digests(old.drop("b"), shape, f"{tmp_path}/old")
    got = capture_by_ranges(old, new, "k", f"{tmp_path}/old", f"{tmp_path}/new", shape, **KW)
    assert rows(got) == rows(capture_changes(old, new, "k", **KW))


def test_null_key_in_an_unequal_range_fails(spark, tmp_path):
    old = version(spark, 600)
    new = old.unionByName(old.where("k = 1").withColumn("k", F.lit(None).cast("long")))
    with pytest.raises(Exception, match="not a primary key"):
        capture_by_ranges(old, new, "k", f"{tmp_path}/a", f"{tmp_path}/b", TreeShape.of(old, "k", width=64), **KW).collect()


def test_many_intervals_are_joined_to_a_bounded_filter():
    shape = TreeShape(("k",), width=10)
    leaves = list(range(0, 4000, 2)) + [10_000]
    got = shape.intervals(leaves)
    assert len(got) == digests.MAX_INTERVALS and got[-1] == (100_000, 100_009)
    assert all(any(a <= leaf * 10 and leaf * 10 + 9 <= b for a, b in got) for leaf in leaves)


def test_composite_keys_go_to_buckets(spark, tmp_path):
    old = version(spark, 2000).select((F.col("k") % 10).alias("x"), F.floor(F.col("k") / 10).alias("y"), "a")
    old = old.dropDuplicates(["x", "y"])
    new = old.withColumn("a", F.when((F.col("x") == 3) & (F.col("y") == 7), F.lit("z")).otherwise(F.col("a")))
    shape = TreeShape.of(old, ["x", "y"], buckets=128)
    assert shape.buckets == 128
    got = capture_by_ranges(old, new, ["x", "y"], f"{tmp_path}/a", f"{tmp_path}/b", shape, **KW)
    assert rows(got) == rows(capture_changes(old, new, ["x", "y"], **KW)) and len(rows(got)) == 1
