"""Publishing stream: audit rows -> topic records, acknowledged in a ledger.

One query serves many tables: the topic is a column (prefix + table name),
so there is no process per table.  Each micro-batch publishes its rows,
then records their ids in the ledger part of its batch id
(``sinks.ledger``).  The checkpoint assigns every audit row to exactly one
batch id and a replayed batch overwrites its own ledger part, so no
micro-batch has to read the (ever-growing) ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.audit import publish_envelope, publish_source
from changelake.sinks.ledger import publish_and_ack


def publish_batch(batch: DataFrame, batch_id: int, send: Callable[[DataFrame], None],
                  ledger: str, db_type: str = "POSTGRESQL", tz: str = "UTC") -> None:
    """Publish the rows of one batch and acknowledge them; messages are rendered from the outbox's copy of the rows."""
    publish_and_ack(publish_source(batch), batch_id, lambda rows: send(publish_envelope(rows, db_type=db_type, tz=tz)), ledger)


def publish_stream(audit: DataFrame, send: Callable[[DataFrame], None], ledger: str,
                   checkpoint: str, trigger: dict | None = None, **kw) -> StreamingQuery:
    """Start publishing a stream of audit rows (every 5 s by default)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, send, ledger, **kw)

    return (
        audit.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
