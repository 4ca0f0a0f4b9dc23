"""Membership join through an inverted index (J1): ``right.element IN left.array`` for long arrays and repeated keys.

:func:`changelake.operators.joins.member_join` meets every row of a key and
then tests membership, which needs a left side that is unique by key.  Here
the elements of the different arrays become the index: rows ``(key, element,
array id)``, joined to the right side on key and element, so only members
meet.  Left rows with one key and array share the index rows and find what
was met by key and array id.  A hot key is spread by its elements in the
first join; the second is an equi-join that adaptive execution can split.

An array's id is made of two 64-bit hashes of its content.  The membership
test stays in the last join's condition, so arrays that should share an id
cannot mix.  No job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.audit import _keys


def _array_id(array: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(1), array, F.size(array)).alias("a"), F.xxhash64(F.lit(2), array, F.size(array)).alias("b"))


def member_index_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, element: str, array_col: str,
                      how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on ``on`` where ``right.element`` is in ``left.array_col``; columns: ``on``, left's, right's.

    * an element that stands in an array twice matches once; NULL keys and NULL elements match nothing;
    * repeated rows on either side match each; with ``how="left"`` left rows without a match stay;
    * the other column names of the two sides must differ, as in any join."""
    if how not in ("inner", "left"):
        raise ValueError(f"member_index_join is an inner or left join, not {how!r}")
    keys = _keys(on)
    identified = left.withColumn("_array", _array_id(F.col(array_col)))
    # each different array of a key once, its elements as rows
    index = (identified.where(F.size(array_col) > 0).groupBy(*keys, "_array").agg(F.first(array_col).alias("_members"))
             .select(*keys, "_array", F.explode(F.array_distinct("_members")).alias("_element")).where("_element is not null"))
    carried = [c for c in right.columns if c not in keys]
    asked = right.select(*keys, F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_right"), F.col(f"`{element}`").alias("_element"))
    met = index.join(asked, [*keys, "_element"])
    met = met.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_array").alias("_met"), "_element", "_right")
    same = (F.col("_array") == F.col("_met")) & F.array_contains(F.col(array_col), F.col("_element"))
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    joined = identified.join(met, same, how)
    own = [c for c in left.columns if c not in keys]
    return joined.select(*keys, *own, *[F.col(f"_right.`{c}`").alias(c) for c in carried])
