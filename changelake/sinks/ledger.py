"""Publish with acknowledgement: the sink write, then the ledger of ids.

Instead of flipping a flag row by row, each batch appends the ids it
published to a ledger folder keyed by batch id; pending rows are the audit
rows absent from the ledger (``operators.audit.unpublished``).  A replayed
batch overwrites its own ledger part, so retries never double-count, and a
batch whose sink write failed leaves its rows pending for the next one
(at-least-once delivery, exactly-once bookkeeping).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def ledger_part(ledger_path: str, batch_id: int) -> str:
    return f"{ledger_path}/batch_id={batch_id}"


def outbox_part(ledger_path: str, batch_id: int) -> str:
    return f"{ledger_path.rstrip('/')}_outbox/batch_id={batch_id}"


def _not_found(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def publish_and_ack(batch: DataFrame, batch_id: int, sink: Callable[[DataFrame], None],
                    ledger_path: str, id_col: str = "audit_log_id") -> None:
    """Send a batch and, when that returned, record its ids.

    Use as (part of) a ``foreachBatch`` function.  The batch is written once
    to the outbox beside the ledger; what is sent and what is acknowledged
    both come from that copy, so a source that would give other rows when
    read again cannot get rows acknowledged that were not sent.  A batch id
    whose part holds other ids is refused: writing it would lose them.
    """
    spark = batch.sparkSession
    outbox, part = outbox_part(ledger_path, batch_id), ledger_part(ledger_path, batch_id)
    batch.write.mode("overwrite").option("compression", "zstd").parquet(outbox)
    copy = spark.read.schema(batch.schema).parquet(outbox)
    ids = copy.select(F.col(id_col).cast("string").alias(id_col))
    try:
        known = spark.read.schema(f"{id_col} string").parquet(part)
    except AnalysisException as error:
        if not _not_found(error):
            raise
    else:
        if not known.join(ids, id_col, "left_anti").isEmpty():
            raise ValueError(f"batch id {batch_id} was used for other ids: {part}")
    sink(copy)
    ids.write.mode("overwrite").option("compression", "zstd").parquet(part)


def read_ledger(spark: SparkSession, ledger_path: str, id_col: str = "audit_log_id") -> DataFrame:
    """All acknowledged ids (empty when nothing was published yet; any other failure to read raises)."""
    try:
        return spark.read.schema(f"{id_col} string").parquet(ledger_path).select(id_col)
    except AnalysisException as error:
        if not _not_found(error):
            raise
        return spark.createDataFrame([], f"{id_col} string")


def next_batch_id(spark: SparkSession, ledger_path: str) -> int:
    """One more than the largest batch id in the ledger (0 for a new one)."""
    try:
        parts = spark.read.format("parquet").schema("batch_id long").load(ledger_path)
    except AnalysisException as error:
        if not _not_found(error):
            raise
        return 0
    last = parts.select(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1
