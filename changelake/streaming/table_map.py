"""Streaming table-map lookup: the map is carried across micro-batches.

Each micro-batch (``foreachBatch``) runs the batch as-of lookup over
``carried map ∪ batch``, where the carried map is the latest record per
table id up to the previous batch.  Output and the new carried map are
written to folders keyed by batch id, so a replayed batch overwrites its
own output and state instead of adding to them.

Batches must arrive in position order: a map record arriving after the
events that needed it cannot correct output already written.  Each part of
the state therefore keeps the highest event position so far, and a map
record at or below it stops the stream.  A replay needs the part before its
own batch only, so older parts are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.rowevents import MAP_KIND, lookup_table_map, row_events_only
from changelake.sinks.lake import remove_path

MAP_COLUMNS = ("position", "table_id", "database", "table")


def _latest_state(spark: SparkSession, state: str, batch_id: int) -> DataFrame | None:
    """Carried map written by the previous micro-batch.

    Micro-batch ids are consecutive and a batch only commits after its
    state is written, so the previous part is read by path: O(1) per
    batch, however long the stream has run.  Only batch 0 starts without
    state; a missing part raises rather than answering "unknown".
    """
    if batch_id == 0:
        return None
    return spark.read.parquet(f"{state}/batch_id={batch_id - 1}").select(*MAP_COLUMNS)


def carry_map(maps: DataFrame) -> DataFrame:
    """Latest map record per table id (one row per id)."""
    latest = maps.groupBy("table_id").agg(
        F.max_by(F.struct(*[F.col(c) for c in MAP_COLUMNS]), F.col("position")).alias("m")
    )
    return latest.select("m.*")


def _high_part(state: str, batch_id: int) -> str:
    return f"{state.rstrip('/')}_high/batch_id={batch_id}"


def _check_order(batch: DataFrame, state: str, batch_id: int) -> int | None:
    """The highest event position up to this batch; raises when a map record comes too late."""
    is_map = F.col("event_type") == MAP_KIND
    first_map, high = batch.agg(F.min(F.when(is_map, F.col("position"))),
                                F.max(F.when(is_map, None).otherwise(F.col("position")))).first()
    if batch_id == 0:
        return high
    before = batch.sparkSession.read.schema("high long").parquet(_high_part(state, batch_id - 1)).first()["high"]
    if before is None:
        return high
    if first_map is not None and first_map <= before:
        raise ValueError(f"batch {batch_id}: a map record at position {first_map} came after events up to {before}")
    return before if high is None else max(before, high)


Sink = Callable[[DataFrame, int], None]


def table_map_batch(batch: DataFrame, batch_id: int, out: str | None, state: str,
                    bucket_width: int = 1 << 20, sink: Sink | None = None) -> None:
    """One micro-batch of the carried lookup.

    The looked-up events go to ``out/batch_id=N`` (overwritten on replay),
    or to ``sink(df, batch_id)`` when given (e.g. a topic writer).
    """
    spark = batch.sparkSession
    batch.persist()
    try:
        carried = _latest_state(spark, state, batch_id)
        high = _check_order(batch, state, batch_id)
        batch_maps = batch.filter(F.col("event_type") == MAP_KIND).select(*MAP_COLUMNS)
        maps = batch_maps if carried is None else carried.unionByName(batch_maps)
        events = row_events_only(batch).drop("database", "table")
        looked = lookup_table_map(events, maps, bucket_width=bucket_width)
        if sink is not None:
            sink(looked, batch_id)
        else:
            looked.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        carry_map(maps).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        spark.createDataFrame([(high,)], "high long").coalesce(1).write.mode("overwrite").parquet(_high_part(state, batch_id))
        if batch_id > 1:
            remove_path(spark, f"{state}/batch_id={batch_id - 2}")
            remove_path(spark, _high_part(state, batch_id - 2))
    finally:
        batch.unpersist()


def table_map_stream(records: DataFrame, out: str | None, state: str, checkpoint: str,
                     bucket_width: int = 1 << 20, trigger: dict | None = None,
                     sink: Sink | None = None) -> StreamingQuery:
    """Start the carried lookup over a stream of landed records."""
    def run(batch: DataFrame, batch_id: int) -> None:
        table_map_batch(batch, batch_id, out, state, bucket_width, sink)

    return (
        records.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
