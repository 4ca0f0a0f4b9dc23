"""Topic source and sink (Structured Streaming Kafka connector)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               stream: bool = True, max_offsets_per_trigger: int | None = None,
               **options: str) -> DataFrame:
    """Topic records ``key, value, topic, partition, offset, timestamp``.

    Without a checkpoint the stream starts at ``starting`` offsets; with one
    it resumes from the committed offsets (the consumer-group position).
    ``max_offsets_per_trigger`` bounds each micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    r = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger and stream:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


CORRUPT = "_corrupt_record"


def read_json_topic(records: DataFrame, schema: T.StructType, keep: tuple[str, ...] = (), flag: bool = False) -> DataFrame:
    """Decode UTF-8 JSON values of topic records with ``schema``.

    A value that is not such JSON gives NULL fields; with ``flag`` a column
    ``bad_reason`` tells these rows apart: ``tombstone`` (no value),
    ``corrupt`` (broken JSON or a field of another type), else NULL.
    """
    text = F.col("value").cast("string")
    if not flag:
        return records.select(*keep, F.from_json(text, schema).alias("_m")).select(*keep, "_m.*")
    noted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = records.select(*keep, "value", F.from_json(text, noted, {"columnNameOfCorruptRecord": CORRUPT}).alias("_m"))
    reason = F.when(F.col("value").isNull(), "tombstone").when(
        F.col("_m").isNull() | F.col(f"_m.{CORRUPT}").isNotNull(), "corrupt")
    return parsed.select(*keep, *[F.col(f"_m.{f}") for f in schema.fieldNames()], reason.alias("bad_reason"))


def write_topic(df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None,
                trigger: dict | None = None) -> StreamingQuery | None:
    """Write ``key, value`` (and ``topic`` when ``topic`` is None) records.

    Batch DataFrames are written once; streaming ones start a query that
    needs ``checkpoint``.
    """
    cols = [c for c in ("key", "value", "topic") if c in df.columns]
    out = df.select(*cols)
    if out.isStreaming:
        w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        if topic:
            w = w.option("topic", topic)
        w = w.option("checkpointLocation", checkpoint)
        if trigger:
            w = w.trigger(**trigger)
        return w.start()
    w = out.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        w = w.option("topic", topic)
    w.save()
    return None
