"""Key discovery and the inverted membership join against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from changelake.operators.keys import discover_keys, is_unique, key_table
from changelake.operators.member_index import member_index_join


def brute_keys(rows, names, size):
    keys = []
    for k in range(1, size + 1):
        for s in combinations(range(len(names)), k):
            got = [tuple(r[i] for i in s) for r in rows]
            if not any(set(x) <= set(s) for x in keys) and len(set(got)) == len(rows) and not any(v is None for g in got for v in g):
                keys.append(s)
    return [tuple(names[i] for i in s) for s in keys]


@pytest.mark.parametrize("seed", range(3))
def test_minimal_keys(spark, seed):
    rnd = random.Random(seed)
    rows = [(i // 20, i % 20, rnd.randrange(40), rnd.randrange(30), rnd.choice([None, 1]) if seed else 1, f"s{i % 200}", (i * 7) % 401)
            for i in range(400)]
    names = list("abcdefg")
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f string, g int").repartition(3)
    want = brute_keys(rows, names, 3)
    assert ("g",) in want and ("a", "b") in want and discover_keys(df) == want
    assert discover_keys(df, 1) == brute_keys(rows, names, 1) and discover_keys(df, 2, ["a", "b", "c"]) == [("a", "b")]


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    assert discover_keys(df) == [] and discover_keys(df.limit(0)) == [] and discover_keys(df.select("a").limit(1)) == [("a",)]
    named = spark.range(5).select(F.col("id").alias("a.b"), F.lit(1).alias("_rows"), F.create_map(F.lit(1), F.col("id")).alias("m"))
    assert discover_keys(named) == [("a.b",)] and is_unique(named, ["a.b"]) and not is_unique(named, ["_rows"])
    assert [tuple(r) for r in key_table(named, "t").collect()] == [("t", "a.b", 1)]


def members(left, right, how):
    out = []
    for k, name, array in left:
        hits = [(k, name, tuple(array or ()), e, v) for rk, e, v in right if k is not None and rk == k and e is not None and e in (array or [])]
        out += hits or ([(k, name, tuple(array or ()), None, None)] if how == "left" else [])
    return sorted(out, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_members(spark, how):
    rnd = random.Random(3)
    left = [(rnd.choice([1, 1, 1, 2, None]), f"n{i}", rnd.choice([None, [], [1, 2, 2, None], list(range(1000)), [rnd.randrange(50) for _ in range(30)]]))
            for i in range(40)]
    left += left[:5]
    right = [(rnd.choice([1, 2, 3, None]), rnd.choice([rnd.randrange(60), None]), f"v{i}") for i in range(120)]
    right += right[:7]
    out = member_index_join(spark.createDataFrame(left, "k int, name string, xs array<int>"), spark.createDataFrame(right, "k int, e int, v string"),
                            "k", "e", "xs", how)
    assert out.columns == ["k", "name", "xs", "e", "v"]
    assert sorted(((r[0], r[1], tuple(r[2] or ()), r[3], r[4]) for r in out.collect()), key=str) == members(left, right, how)


def test_several_key_columns_and_no_eager_job(spark):
    left = spark.createDataFrame([(1, 2, ["a", "b"]), (1, 3, ["a"])], "k int, j int, xs array<string>")
    right = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (1, 2, "c")], "k int, j int, e string")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = member_index_join(left, right, ["k", "j"], "e", "xs")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert [tuple(r) for r in out.collect()] == [(1, 2, ["a", "b"], "a")]
    with pytest.raises(ValueError):
        member_index_join(left, right, "k", "e", "xs", "outer")
    assert member_index_join(left.limit(0), right, ["k", "j"], "e", "xs").collect() == []


def test_near_keys_need_few_passes_over_the_table(spark, monkeypatch):
    """Sets with nearly as many values as rows are told by a slice of their values or by the few rows a part repeats."""
    from changelake.operators import keys as module

    rnd = random.Random(5)
    rows = [(i // 4, i % 4, rnd.randrange(3000), rnd.randrange(2500), rnd.randrange(2000), rnd.randrange(50)) for i in range(4000)]
    names = list("olpedq")
    df = spark.createDataFrame(rows, "o int, l int, p int, e int, d int, q int").repartition(3)
    whole = []

    def counted(frame, columns):
        n = frame.count()
        whole.append(tuple(columns)) if n == len(rows) else None
        return is_unique(frame, columns)

    monkeypatch.setattr(module, "SLICE_ROWS", 500, raising=False)
    monkeypatch.setattr(module, "is_unique", counted)
    want = brute_keys(rows, names, 3)
    assert ("o", "l") in want and len(want) > 3
    assert discover_keys(df) == want
    assert len([s for s in whole if len(s) == 3]) <= 2


def test_answers_do_not_depend_on_a_hash(spark, monkeypatch):
    """Whatever the hashes are, sets are told apart by their values, on slices and on the whole table."""
    from changelake.operators import keys as module

    whole = F.xxhash64
    rnd = random.Random(7)
    rows = [(i // 4, f"s{i % 4}", rnd.randrange(3000), rnd.randrange(2500) / 7, rnd.randrange(3), None if i == 9 else i) for i in range(4000)]
    rows[50] = rows[50][:2] + rows[53][2:4] + rows[50][4:]
    names = list("olpeqn")
    df = spark.createDataFrame(rows, "o int, l string, p int, e double, q int, n int").repartition(3)
    want = brute_keys(rows, names, 3)
    assert ("o", "l") in want and len(want) > 3
    monkeypatch.setattr(module, "SLICE_ROWS", 300)
    assert discover_keys(df) == want
    monkeypatch.setattr(module.F, "xxhash64", lambda *c: F.pmod(whole(*c), F.lit(60)))
    assert discover_keys(df) == want


def test_many_sets_need_few_scans_of_the_table(spark, monkeypatch):
    """The sets are met on slices; the whole table is read a few times, however many sets there are."""
    from changelake.operators import keys as module

    rnd = random.Random(11)
    rows = [(i // 4, i % 4, *(rnd.randrange(m) for m in (3000, 2500, 2000, 1500, 900, 50, 11, 3))) for i in range(3000)]
    names = list("olpedsxqtr")
    read = spark.sparkContext.accumulator(0)

    def noted(x):
        read.add(1)
        return x

    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names)).repartition(3)
    df = df.withColumn("o", F.udf(noted, "int").asNondeterministic()("o"))
    monkeypatch.setattr(module, "SLICE_ROWS", 300)
    assert discover_keys(df) == brute_keys(rows, names, 3)
    assert read.value <= 8 * len(rows)
    read.value = 0
    # repeated rows show in the slices
    assert discover_keys(df.union(df)) == []
    assert read.value <= 3 * 2 * len(rows)


def test_strings_of_a_collation_are_compared_by_it(spark, monkeypatch):
    from changelake.operators import keys as module

    df = spark.range(2000).select(F.concat(F.lit("a"), F.col("id")).alias("x"), (F.col("id") % 40).alias("y"))
    twice = df.union(df.limit(1).select(F.upper("x"), F.col("y") + 40))
    monkeypatch.setattr(module, "SLICE_ROWS", 300)
    assert discover_keys(twice) == [("x",)]
    assert discover_keys(twice.select(F.expr("collate(x, 'UTF8_LCASE')").alias("x"), "y")) == [("x", "y")]
