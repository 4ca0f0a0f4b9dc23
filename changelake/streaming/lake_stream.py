"""Stream change records into the date-partitioned Parquet lake.

The file sink is exactly-once: its ``_spark_metadata`` log and the
checkpoint (offsets + commits) make a restarted query neither lose nor
repeat files.  Without a checkpoint a topic source starts at ``latest``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.sinks.lake import LAKE_PARTITIONS, write_batch

# Fixed value: default poll period of the publisher.
DEFAULT_TRIGGER = {"processingTime": "5 seconds"}


def cluster_by_day(sdf: DataFrame, by: Sequence[str], day_spread: int) -> DataFrame:
    """Group each date's rows into ``day_spread`` tasks (salted by row hash).

    Bounds files per date folder per micro-batch to ``day_spread`` and
    splits a hot date over that many tasks instead of one.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in sdf.columns]), F.lit(day_spread))
    return sdf.repartition(*[F.col(c) for c in by], salt)


def write_lake_stream(sdf: DataFrame, path: str, checkpoint: str,
                      by: Sequence[str] = LAKE_PARTITIONS, trigger: dict | None = None,
                      name: str | None = None, day_spread: int | None = None,
                      max_records_per_file: int | None = None) -> StreamingQuery:
    """Append ``sdf`` to Parquet under ``path`` partitioned by ``by``.

    Map-only by default: a live change stream covers a day or two per
    micro-batch, so each task writes one or two folders.  For a backfill
    spanning many dates pass ``day_spread`` (see :func:`cluster_by_day`);
    that adds one shuffle per micro-batch.
    """
    if day_spread:
        sdf = cluster_by_day(sdf, by, day_spread)
    w = (
        sdf.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy(*by)
        .trigger(**(trigger or DEFAULT_TRIGGER))
    )
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if name:
        w = w.queryName(name)
    return w.start()


def held_batch(batch: DataFrame) -> DataFrame:
    """A backfill's batch of flagged rows, persisted; usable rows leave their raw message behind.

    The source has as many splits as cores however large they are; a rebalance bounds what a task keeps and reads back."""
    message = F.when(F.col("bad_reason").isNotNull(), F.col("message"))
    return batch.withColumn("message", message).hint("rebalance").persist()


def split_lake_stream(flagged: DataFrame, good: Callable[[DataFrame], DataFrame], bad: Callable[[DataFrame], DataFrame],
                      lake: str, quarantine: str, checkpoint: str, trigger: dict | None = None,
                      by: Sequence[str] = LAKE_PARTITIONS, day_spread: int | None = None,
                      max_records_per_file: int | None = None) -> StreamingQuery:
    """One query for both outputs: each micro-batch of ``flagged`` rows is read and
    parsed once, then ``good(rows)`` goes to the lake and ``bad(rows)`` to the quarantine,
    both keyed by batch id (:func:`changelake.sinks.lake.write_batch`)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = held_batch(batch) if day_spread else batch.persist()
        try:
            rows = good(batch)
            write_batch(cluster_by_day(rows, by, day_spread) if day_spread else rows, bad(batch), batch_id,
                        lake, quarantine, by, max_records_per_file)
        finally:
            batch.unpersist()

    return (
        flagged.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for ``availableNow``/``once`` queries, always stopping them."""
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
