"""Finding the keys of a table (J5): all smallest sets of columns that tell its rows apart.

A set is no key if it has a column with NULLs or if two rows agree on it.  Most
sets are disproved on slices of the table: for each column all rows of some of
its values, so rows that agree on a set with that column are in a slice together
or not at all.  The sets that are left are searched by size, leaving out those
that hold a smaller key, and decided on the whole table: one scan for several
sets looks for hashes that come twice, and the rows that have them are compared
by their columns.  Sets that share a part with few repeated rows are decided on
these rows.  A hash only leads to rows to compare, so what is returned is exact.
Only numbers reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast
from changelake.session import default_parallelism, scratch_path

SLICE_ROWS = 1 << 18  # rows of a column's slice, about
FINE = 32  # a fine slice is so many times smaller
UNEVEN = 4  # a slice so many times larger, of a column with few values or a frequent one, is not used
SETS_AT_ONCE = 256
WHOLE_SETS_AT_ONCE = 8  # in one scan of the whole table
TASK_ROWS = 1 << 19  # hashes of a task, about
ANY = -1  # the slice of every so many-th row, for all sets

Set = tuple[int, ...]  # the numbers of its columns; column k is called c<k>


def is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree on the columns (NULLs count as equal here)."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where("_n > 1").limit(1).isEmpty()


def _literal(sets: Sequence[Set]) -> Column:
    return F.array(*[F.array(*[F.lit(k) for k in (*s, ANY)]) for s in sets])


def _own(numbers: Sequence[int]) -> list[Column]:
    """Those of the columns that are in the row's set, the others NULL."""
    return [F.when(F.array_contains("set", F.lit(k)), F.col(f"c{k}")).alias(f"c{k}") for k in numbers]


def _hashed(df: DataFrame, sets: Sequence[Set]) -> DataFrame:
    """Every row for every set, with the set's place ``s``, its columns' numbers ``set`` and a hash ``h`` of their values."""
    numbers = sorted({k for s in sets for k in s})
    # strings that are equal by their collation may differ in bytes
    plain = [k for k in numbers if "collate" not in df.schema[f"c{k}"].dataType.simpleString()]
    hashes = F.array(*[F.xxhash64(f"c{k}") if k in plain else F.lit(0).cast("long") for k in range(max(numbers) + 1)])
    every = df.select("*", hashes.alias("hashes")).select("*", F.posexplode(_literal(sets)).alias("s", "set"))
    return every.withColumn("h", F.xxhash64(*[F.get("hashes", F.get("set", F.lit(i))) for i in range(max(map(len, sets)))]))


def _in_slices(slices: DataFrame, sets: Sequence[Set], rows: int) -> DataFrame:
    """As ``_hashed``, with the rows of the slices of the set's columns, about ``rows`` for a set."""
    # the slices are small and in few files, but every row stands for many sets
    tasks = max(default_parallelism(slices.sparkSession), len(sets) * rows // TASK_ROWS)
    return _hashed(slices.repartition(tasks), sets).where(F.arrays_overlap("set", "hit"))


def _twice(hashed: DataFrame) -> DataFrame:
    """``(s, h, n)`` of the hashes that n > 1 rows of a set have."""
    return hashed.groupBy("s", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _agreed(hashed: DataFrame, hashes: DataFrame, held: Sequence[Sequence[Set]]) -> set[Set]:
    """Which sets of ``held[s]`` two rows agree on that have a hash of ``hashes(s, h)``."""
    rows = hashed.join(hashes, ["s", "h"], "left_semi")
    numbers = sorted({k for sets in held for s in sets for k in s})
    every = rows.select("s", *[f"c{k}" for k in numbers], F.posexplode(F.element_at(F.array(*[_literal(sets) for sets in held]), F.col("s") + 1)).alias("t", "set"))
    counted = every.select("s", "t", *_own(numbers)).groupBy("s", "t", *[f"c{k}" for k in numbers]).agg(F.count(F.lit(1)).alias("n"))
    return {held[r["s"]][r["t"]] for r in counted.where("n > 1").select("s", "t").distinct().collect()}


def _disproved(slices: DataFrame, sets: Sequence[Set], rows: int) -> set[Set]:
    """Those of ``sets`` that two rows of the slices agree on."""
    out: set[Set] = set()
    for at in range(0, len(sets), SETS_AT_ONCE):
        part = sets[at:at + SETS_AT_ONCE]
        hashed = _in_slices(slices, part, rows)
        # two hashes of a set will do
        some = _twice(hashed).groupBy("s").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).collect()
        if some:
            hashes = slices.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"({r['s']}, {r['lo']}L), ({r['s']}, {r['hi']}L)" for r in some) + " AS t(s, h)")
            out |= _agreed(hashed, F.broadcast(hashes), [[s] for s in part])
    return out


def _rare(slices: DataFrame, sets: Sequence[Set], rows: int, sliced: Sequence[int], times: int) -> set[Set]:
    """Those of ``sets`` that few rows of the whole table seem to agree on."""
    sets, out = [s for s in sets if set(s) & set(sliced)], set()
    for at in range(0, len(sets), SETS_AT_ONCE):
        part = sets[at:at + SETS_AT_ONCE]
        met = {r["s"]: r["n"] for r in _twice(_in_slices(slices, part, rows)).groupBy("s").agg(F.sum("n").alias("n")).collect()}
        out |= {s for i, s in enumerate(part) if met.get(i, 0) * times <= DEFAULT_MAX_BROADCAST_ROWS * len(set(s) & set(sliced))}
    return out


def _shared(sets: Sequence[Set], rare: set[Set]) -> list[tuple[Set, list[Set]]]:
    """Each of ``sets`` under a part of ``rare`` that it has in common with others, or else under itself."""
    out, left = [], list(sets)
    while left:
        parts = Counter(p for s in left for i in range(len(s)) if (p := s[:i] + s[i + 1:]) in rare)
        part, n = parts.most_common(1)[0] if parts else ((), 0)
        if n < 2:
            return out + [(s, [s]) for s in left]
        out.append((part, [s for s in left if set(part) <= set(s)]))
        left = [s for s in left if s not in out[-1][1]]
    return out


def _repeated(df: DataFrame, shared: Sequence[tuple[Set, list[Set]]], rows: int) -> set[Set]:
    """Those of the sets, each under a part of it, that two of all ``rows`` rows agree on."""
    out: set[Set] = set()
    for at in range(0, len(shared), WHOLE_SETS_AT_ONCE):
        parts, held = zip(*shared[at:at + WHOLE_SETS_AT_ONCE])
        hashed, path = _hashed(df, parts), scratch_path(df.sparkSession, "key-hashes")
        # nearly all hashes are met once: counting them before they are dealt out would only cost
        tasks = max(default_parallelism(df.sparkSession), len(parts) * rows // TASK_ROWS)
        twice = _twice(hashed.select("s", "h").repartition(tasks, "h"))
        twice.write.parquet(path)
        twice = df.sparkSession.read.schema(twice.schema).parquet(path)
        met = [r["s"] for r in twice.select("s").distinct().collect()]
        if met:
            out |= _agreed(hashed.where(F.col("s").isin(met)), checked_broadcast(twice.select("s", "h")), held)
    return out


def discover_keys(df: DataFrame, max_columns: int = 3, columns: Sequence[str] | None = None) -> list[tuple[str, ...]]:
    """The minimal keys of up to ``max_columns`` of ``columns`` (all when None), smaller ones first, columns in the table's order.

    A key has no NULL.  An empty table shows no key.  Columns of map type cannot be compared and are left out."""
    names = [f.name for f in df.schema.fields if (columns is None or f.name in columns) and f.dataType.typeName() != "map"]
    df = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    n = df.count()
    times = max(1, n // SLICE_ROWS)
    hit = {(k, m): F.pmod(F.xxhash64(f"c{k}"), F.lit(m)) == 0 for k in range(len(names)) for m in {times, times * FINE}}
    sizes = df.agg(F.lit(0).alias("none"), *[F.count(f"c{k}").alias(f"n{k}") for k in range(len(names))],
                   *[F.count_if(h).alias(f"n{k}_{m}") for (k, m), h in hit.items()]).first()
    usable = [k for k in range(len(names)) if sizes[f"n{k}"] == n]
    if not n or not usable or max_columns < 1:
        return []
    df = df.select(*[f"c{k}" for k in usable])
    sliced, fine = ([k for k in usable if 0 < sizes[f"n{k}_{m}"] <= UNEVEN * n // m] for m in (times, times * FINE))
    marks = {k: hit[k, times] for k in sliced} | {ANY: F.col("any")}
    slices = df.withColumn("any", F.pmod(F.monotonically_increasing_id(), F.lit(times)) == 0).where(reduce(or_, marks.values()))
    slices = slices.select(*df.columns, F.array(*[F.when(m, F.lit(k)).otherwise(F.lit(ANY - 1)) for k, m in marks.items()]).alias("hit"))
    if times > 1:
        path = scratch_path(df.sparkSession, "key-slices")
        slices.write.parquet(path)
        slices = df.sparkSession.read.schema(slices.schema).parquet(path)
    few = slices.where(reduce(or_, [hit[k, times * FINE] for k in fine], F.pmod(F.monotonically_increasing_id(), F.lit(FINE)) == 0))
    wide = list(combinations(usable, min(max_columns, len(usable))))
    # all sets with the rows of all fine slices
    known = _disproved(few.withColumn("hit", F.array(F.lit(ANY))), wide, n * (len(fine) + 1) // (times * FINE))
    keys: list[Set] = []
    for size in range(1, max_columns + 1):
        below = {p for s in known for p in combinations(s, size)}  # rows that agree on a set agree on its parts
        left = [s for s in combinations(usable, size) if s not in below and not any(set(k) <= set(s) for k in keys)]
        rows = min(n, n * (size + 1) // times)
        wrong = _disproved(slices, left, rows)
        left = [s for s in left if s not in wrong]
        if times > 1 and left:
            parts = [p for p, m in Counter(p for s in left for p in combinations(s, size - 1)).items() if p and m > 1]
            wrong = _repeated(df, _shared(left, _rare(slices, parts, rows, sliced, times)), n)
            left = [s for s in left if s not in wrong]
        # else one slice was the whole table
        keys += left
    return [tuple(names[k] for k in s) for s in keys]


def key_table(df: DataFrame, name: str, max_columns: int = 3) -> DataFrame:
    """``(table_name, key_columns, n_columns)`` of the minimal keys."""
    keys = [(name, ",".join(k), len(k)) for k in discover_keys(df, max_columns)]
    return df.sparkSession.createDataFrame(keys, "table_name string, key_columns string, n_columns int")
