"""Date-partitioned Parquet lake (batch side) and table registration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.audit import unpublished

LAKE_PARTITIONS = ("year", "month", "day")
BATCH_COLUMN = "batch_id"
CAPTURE_COLUMN = "capture_version"


# Adaptive execution may merge small dates down to this size, so that a write of many small dates keeps its cores busy.
MIN_TASK_BYTES = "64KB"


@contextmanager
def _sql_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_lake(df: DataFrame, path: str, by: Sequence[str] = LAKE_PARTITIONS,
               mode: str = "append", max_records_per_file: int | None = None,
               balance: str = "rebalance") -> None:
    """Write ``df`` as Parquet partitioned by ``by``.

    ``rebalance`` on the partition columns: adaptive execution splits a date
    holding a third of the rows across several tasks and merges small dates
    (few files per folder), at every size alike.  ``balance="hash"`` puts
    each date into one task instead; ``max_records_per_file`` caps file size
    within a folder.
    """
    if balance not in ("rebalance", "hash"):
        raise ValueError(f"balance must be rebalance or hash, not {balance!r}")
    out = df.hint("rebalance", *by) if balance == "rebalance" else df.repartition(*by)
    w = out.write.mode(mode).partitionBy(*by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    with _sql_conf(df.sparkSession, "spark.sql.adaptive.coalescePartitions.minPartitionSize", MIN_TASK_BYTES):
        w.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))  # noqa: SLF001


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders of a folder (none where there is no folder)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder (nothing happens where there is none)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001


def append_audit(audit: DataFrame, path: str, by: Sequence[str] = (), id_col: str = "audit_log_id") -> None:
    """Append audit rows (never rewrites earlier ones).

    Rows whose id is in the table already are left out, so a capture that is
    run again, whole or after a failure, adds nothing twice.  This reads one
    column of the table.
    """
    spark = audit.sparkSession
    if path_exists(spark, path):
        known = spark.read.schema(audit.select(id_col).schema).parquet(path)
        audit = unpublished(audit, known, id_col).select(audit.columns)
    w = audit.write.mode("append").option("compression", "zstd")
    if by:
        w = w.partitionBy(*by)
    w.parquet(path)


def append_capture(audit: DataFrame, path: str, version: str) -> bool:
    """Write one capture's audit rows to the folder of its version; False if that version is complete already.

    Nothing that is there is read: a complete folder carries the writer's mark, and one that a lost run left
    without it is written anew.  Tables with and without such folders do not mix.
    """
    spark, at = audit.sparkSession, f"{path.rstrip('/')}/{CAPTURE_COLUMN}={quote(version, safe='')}"
    if path_exists(spark, f"{at}/_SUCCESS"):
        return False
    if any(not name.startswith((f"{CAPTURE_COLUMN}=", "_", ".")) for name in child_names(spark, path)):
        raise ValueError(f"{path} holds rows outside folders of a capture: append with append_audit")
    (audit.write.mode("overwrite").option("compression", "zstd")
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(at))
    return True


def write_batch(good: DataFrame, bad: DataFrame, batch_id: int, lake: str, quarantine: str,
                by: Sequence[str] = LAKE_PARTITIONS, max_records_per_file: int | None = None) -> None:
    """Write one micro-batch: ``good`` below its dates, ``bad`` to the quarantine.

    The innermost folder is the batch's own (``batch_id=N``), and only
    folders that the batch writes are replaced, so a replay overwrites what
    it wrote before and nothing else.
    """
    for df, path, parts in ((good, lake, [*by, BATCH_COLUMN]), (bad, quarantine, [BATCH_COLUMN])):
        w = (df.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*parts))
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        w.parquet(path)


def write_quarantine(bad: DataFrame, batch_id: int, quarantine: str) -> None:
    """Write one micro-batch's unusable messages to a folder of the batch; a replay overwrites it."""
    (bad.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(quarantine))


def write_console(sdf: DataFrame, truncate: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """Print a stream in append mode (debugging)."""
    w = sdf.writeStream.format("console").outputMode("append").option("truncate", str(truncate).lower())
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None,
                 partitioned_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS name (...) USING parquet``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet"
    if partitioned_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partitioned_by) + ")"
    if path:
        sql += f" LOCATION '{path}'"
    spark.sql(sql)


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream wrote the folder (it then holds its own file log)."""
    return path_exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def register_lake(spark: SparkSession, name: str, path: str, streamed: bool | None = None,
                  by: Sequence[str] = LAKE_PARTITIONS) -> None:
    """Expose a lake folder as a SQL table.

    A stream-written folder carries its own file log (``_spark_metadata``),
    which is the authority on its files, so it is registered without
    partition discovery; a batch-written one is registered partitioned and
    its folders are added with ``MSCK REPAIR TABLE``.  Which one it is, is
    read from the folder unless ``streamed`` says so.
    """
    if is_streamed(spark, path) if streamed is None else streamed:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        return
    schema = spark.read.parquet(path).schema
    if BATCH_COLUMN in schema.names:
        by = (*by, BATCH_COLUMN)
    data_cols = [f for f in schema.fields if f.name not in by]
    part_cols = [f for f in schema.fields if f.name in by]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data_cols + part_cols)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
