"""Table-map lookup of a stream whose map records may come late (T8).

Events are answered at once from the maps known so far.  A map record that
comes after events behind it is no error: the answers that it changes are
taken back and given anew.  The output is a log of rows with ``change``: +1
gives an answer, -1 takes one back (larger numbers stand for equal rows);
summed up they are the answers that the as-of lookup over all records gives
(:func:`current_answers`).

The state is the log itself and the maps, in folders keyed by batch id, so a
replayed batch overwrites its own part and reads earlier parts only.  A batch
reads old answers from the position of its first map record on, which the
scan prunes by; maps that come in order find none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.joins import checked_broadcast
from changelake.operators.rowevents import MAP_KIND, lookup_table_map, row_events_only
from changelake.streaming.table_map import MAP_COLUMNS

ANSWER = ("position", "table_id", "database", "table")
MAP_SCHEMA = "position long, table_id long, database string, table string, batch_id long"
LOG_SCHEMA = "position long, table_id long, database string, table string, change long, batch_id long"


def _parts(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The rows that earlier batches wrote."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    # every batch writes its part, so batch 0's is there
    return spark.read.option("basePath", path).schema(schema).parquet(path).where(F.col("batch_id") < batch_id)


def _net(log: DataFrame) -> DataFrame:
    return log.groupBy(*ANSWER).agg(F.sum("change").alias("change")).where("change <> 0")


def late_map_batch(batch: DataFrame, batch_id: int, root: str, bucket_width: int = 1 << 20) -> None:
    """One micro-batch: answers of its events, and earlier answers that its maps change."""
    spark = batch.sparkSession
    batch.persist()
    try:
        own = batch.filter(F.col("event_type") == MAP_KIND).select(*[F.col(c).cast(k) for c, k in zip(MAP_COLUMNS, ("long", "long", "string", "string"))])
        own.write.mode("overwrite").parquet(f"{root}/maps/batch_id={batch_id}")
        own = spark.read.schema("position long, table_id long, database string, table string").parquet(f"{root}/maps/batch_id={batch_id}")
        maps = _parts(spark, f"{root}/maps", MAP_SCHEMA, batch_id).select(*MAP_COLUMNS).unionByName(own)
        events = row_events_only(batch).select(F.col("position").cast("long"), F.col("table_id").cast("long"))
        out = lookup_table_map(events, maps, bucket_width=bucket_width).select(*ANSWER, F.lit(1).cast("long").alias("change"))
        first = own.agg(F.min("position")).first()[0]
        if batch_id and first is not None:
            reach = checked_broadcast(own.groupBy("table_id").agg(F.min("position").alias("since")))
            old = _parts(spark, f"{root}/answers", LOG_SCHEMA, batch_id).where(F.col("position") >= first)
            old = _net(old.join(reach, "table_id").where(F.col("position") >= F.col("since")).select(*ANSWER, "change"))
            asked = old.select("position", "table_id", F.col("database").alias("_database"), F.col("table").alias("_table"), "change")
            again = lookup_table_map(asked, maps, bucket_width=bucket_width)
            same = F.col("database").eqNullSafe(F.col("_database")) & F.col("table").eqNullSafe(F.col("_table"))
            moved = again.where(~same).select("position", "table_id", F.explode(F.array(
                F.struct(F.col("_database").alias("database"), F.col("_table").alias("table"), (-F.col("change")).alias("change")),
                F.struct(F.col("database"), F.col("table"), F.col("change")))).alias("a"))
            out = out.unionByName(moved.select("position", "table_id", "a.database", "a.table", "a.change"))
        out.write.mode("overwrite").parquet(f"{root}/answers/batch_id={batch_id}")
    finally:
        batch.unpersist()


def late_map_stream(records: DataFrame, root: str, checkpoint: str, bucket_width: int = 1 << 20, trigger: dict | None = None) -> StreamingQuery:
    """Start the lookup over a stream of landed records in any order."""
    return (records.writeStream.foreachBatch(lambda batch, batch_id: late_map_batch(batch, batch_id, root, bucket_width))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def answer_log(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the log with their batch."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/answers")


def current_answers(spark: SparkSession, root: str) -> DataFrame:
    """The answers that stand, one row for each event."""
    return _net(answer_log(spark, root)).withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("change")))).select(*ANSWER)
