"""Counts of what a stream saw, by kind, observed while each batch is written (P17).

The counts ride on the batch's own work (``observe``): nothing is read
twice.  They are stored in a folder of the batch, which a replay overwrites,
so the sums over all batches stay right across restarts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

OTHER = "other"
ROWS = "rows"
COUNTS_SCHEMA = "kind string, n long"

Run = Callable[[DataFrame, int], None]


def counted_batches(run: Run, path: str, column: str, kinds: Sequence[str]) -> Run:
    """``run`` for ``foreachBatch`` that stores, below ``path``, how many rows of each batch have each of ``kinds``
    in ``column``, and how many have another value or none (``other``).

    ``run`` must read its whole batch once at least; the counts are those of the first complete reading."""
    def counted(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation(f"counts-{batch_id}-{uuid.uuid4().hex[:8]}")
        named = {f"k{i}": F.count_if(F.col(column) == k) for i, k in enumerate(kinds)}
        run(batch.observe(seen, F.count(F.lit(1)).alias(ROWS), *[c.alias(name) for name, c in named.items()]), batch_id)
        found = seen.get
        counts = [(k, int(found[f"k{i}"])) for i, k in enumerate(kinds)]
        counts.append((OTHER, int(found[ROWS]) - sum(n for _, n in counts)))
        spark.createDataFrame(counts, COUNTS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return counted


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, kind, n`` of all batches."""
    return spark.read.schema(f"{COUNTS_SCHEMA}, batch_id long").parquet(path).select("batch_id", "kind", "n")
