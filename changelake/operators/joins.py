"""Join helpers: size-checked broadcast, array-membership join, as-of lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.audit import require_unique_key
from changelake.session import estimated_bytes

# Broadcast only below these measured bounds; above them a shuffle join is used.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Exact ``(rows, bytes)`` of ``df`` from one distributed aggregate.

    Bytes bound an UnsafeRow image: 8 bytes per field and null word, plus
    the UTF-8 length of string/binary fields (JSON length for nested ones).
    Partial aggregation runs in every task; only one row per task is
    shuffled, so no task sees more than its own split.
    """
    fixed = 8 * (len(df.columns) + 1)
    row_bytes = F.lit(fixed).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            row_bytes = row_bytes + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            row_bytes = row_bytes + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
    probe = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")).first()
    return int(probe["n"]), int(probe["b"])


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its measured size is within bounds, else ``df``.

    A side whose plan estimate is far above the bound is rejected without
    touching data; otherwise its exact size is measured.  The unhinted
    fallback leaves the choice to the planner and AQE, which converts to a
    broadcast only from measured shuffle sizes.
    """
    est = estimated_bytes(df)
    if est is not None and est > 8 * max_bytes:
        return df
    rows, size = measured_size(df)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df)
    return df


def member_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str,
                element: str, array_col: str, how: str = "inner",
                validate_left: bool = True) -> DataFrame:
    """Equi-join on ``on`` plus the condition ``right.element IN left.array_col``.

    The equi keys drive the (shuffle or broadcast) join; the membership test
    is a residual condition evaluated per matched pair.  ``left`` holds one
    row per key (an index row with its member list); ``validate_left``
    checks it, so the output stays linear in ``right``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"member_join is an inner or left join, not {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if validate_left:
        require_unique_key(left, keys, "member_join left side")
    l, r = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in keys]
    cond.append(F.array_contains(F.col(f"_l.{array_col}"), F.col(f"_r.{element}")))
    out = l.join(r, cond, how)
    # keep one copy of the equi keys
    right_cols = [F.col(f"_r.{c}") for c in right.columns if c not in keys]
    return out.select(*[F.col(f"_l.{c}") for c in left.columns], *right_cols)


def asof_lookup(events: DataFrame, maps: DataFrame, key: str, pos: str,
                values: Sequence[str], bucket_width: int = 1 << 20, levels: int = 1) -> DataFrame:
    """For each event row, the ``values`` of the latest map row with the same
    ``key`` and ``map.pos <= event.pos`` (NULLs when none).

    Two-level scan so that one hot key never lands in one task:

    1. Events and map rows are shuffled once, by ``(key, pos div
       bucket_width)``; within each bucket a running ``last(ignorenulls)``
       finds the latest map row at or before every event.
    2. The latest map row of every bucket, from the map rows alone, is carried
       forward to the later buckets of its key that hold events.  This needs
       the distinct buckets of the events, a scan of key and position with
       map-side aggregation; its window sees one row per bucket, not per event.
    3. The carried value is equi-joined back on ``(key, bucket)``, reusing
       the partitioning of step 1.

    With ``levels`` above 1 the carrying of step 2 is itself such a scan, over
    buckets of buckets, so a key with very many buckets is spread as well.

    Map rows sort before event rows at the same position.  A NULL key or
    position never matches.
    """
    # dropping map rows with a NULL key or position keeps the window from
    # pairing NULL keys with each other
    known = maps.filter(F.col(key).isNotNull() & F.col(pos).isNotNull()).select(
        key, pos, F.struct(*[F.col(v) for v in values]).alias("_val"))
    found = _latest(events, known, key, pos, int(bucket_width), levels, before=False)
    return found.select(*events.columns, *[F.col(f"_val.{v}").alias(v) for v in values])


def _latest(events: DataFrame, maps: DataFrame, key: str, pos: str, width: int, levels: int, before: bool) -> DataFrame:
    """``events`` with ``_val`` of the latest ``maps(key, pos, _val)`` row at or before
    each (``before``: strictly before), through ``levels`` levels of buckets."""
    kind = F.col("_kind").desc() if before else F.col("_kind")
    none = F.lit(None).cast(maps.schema["_val"].dataType)
    tagged = events.withColumns({"_kind": F.lit(1), "_val": none}).unionByName(
        maps.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    if levels < 1:
        upto = Window.partitionBy(key).orderBy(F.col(pos), kind).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return tagged.withColumn("_val", F.last("_val", ignorenulls=True).over(upto)).filter("_kind = 1").drop("_kind")

    # exact integer division (monotonic in pos, which is all bucketing needs)
    slot = f"_bucket{levels}"
    bucket = F.expr(f"CAST(`{pos}` AS BIGINT) div {width}")
    inside = Window.partitionBy(key, slot).orderBy(F.col(pos), kind).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = tagged.withColumn(slot, bucket).withColumn("_val", F.last("_val", ignorenulls=True).over(inside)).filter("_kind = 1")

    wanted = events.filter(F.col(key).isNotNull() & F.col(pos).isNotNull()).select(key, bucket.alias(slot)).distinct()
    latest = maps.groupBy(key, bucket.alias(slot)).agg(F.max_by("_val", pos).alias("_val"))
    carried = _latest(wanted, latest, key, slot, width, levels - 1, before=True).withColumnRenamed("_val", "_carried")
    joined = scanned.join(carried, [key, slot], "left")
    return joined.withColumn("_val", F.coalesce("_val", "_carried")).drop("_kind", "_carried", slot)
