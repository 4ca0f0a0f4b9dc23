"""Re-delivered messages (at-least-once publishing) removed downstream.

Deduplicate on the audit row id: ``hash_pk`` is second-resolution and two
changes of one record within a second share it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.sinks.runs import RunLedger, publish_once
from changelake.streaming.lake_stream import DEFAULT_TRIGGER

ARRIVAL = "_arrival"
ALONE = "_alone"


def drop_redelivered(df: DataFrame, ids: Sequence[str] = ("audit_log_id",)) -> DataFrame:
    """Batch form: one row per id (an aggregate with map-side partial
    aggregation, so a hot id collapses before the shuffle)."""
    return df.dropDuplicates(list(ids))


def drop_redelivered_stream(sdf: DataFrame, arrival: str | None = None, horizon: str = "7 days",
                            ids: Sequence[str] = ("audit_log_id",)) -> DataFrame:
    """Streaming form: the first message of each id, however the input is cut into batches.

    No row is dropped for its event time.  Without ``arrival`` every id is
    remembered.  With it (the topic's record time, or the modification time
    of landed files: a time that never runs backwards by more than
    ``horizon``), ids are forgotten ``horizon`` after they arrived, which
    bounds the state to the ids of that span.  A message that arrives later
    than that behind the newest one would count as late and be dropped, so
    ``horizon`` must exceed both the longest retry and any disorder between
    topic partitions.
    """
    if arrival is None:
        return sdf.dropDuplicates(list(ids))
    timed = sdf.withColumn(ARRIVAL, F.col(arrival).cast("timestamp")).withWatermark(ARRIVAL, horizon)
    return timed.dropDuplicatesWithinWatermark(list(ids)).drop(ARRIVAL)


def drop_redelivered_ledger(sdf: DataFrame, sink: Callable[[DataFrame, int], None], ledger: RunLedger, checkpoint: str,
                            trigger: dict | None = None) -> StreamingQuery:
    """Streaming form whose memory is a ledger of sorted runs: no state store, no horizon, every id remembered.

    Each batch gives ``sink(rows, batch_id)`` the rows whose id neither an earlier batch nor an earlier copy in the
    batch had, from one written copy, and adds their ids to the ledger.  A crash between the two sends the batch
    again under its number with the same ids, so the sink must replace or skip what it holds of that number
    (``SnapshotLake.append``, ``write_batch``).  Rows without an id are all kept.
    """
    id_col = ledger.id_col

    def run(batch: DataFrame, batch_id: int) -> None:
        # rows without an id are copies of nothing
        first = batch.withColumn(ALONE, F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())).dropDuplicates([id_col, ALONE])
        publish_once(ledger.absent(first.drop(ALONE)), batch_id, lambda rows: sink(rows, batch_id), ledger)

    return sdf.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)).start()
