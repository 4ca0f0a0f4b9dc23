"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole given tables.  ``plans.oracle.oracle_sql()`` holds, per query,
the DuckDB statement that computes the same rows straight from the base
tables (so a decode error cannot hide in a path both sides share)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changelake.functions.hashing import packed_id, unpacked_id
from changelake.functions.jsoncols import json_field
from changelake.operators import changelog as cl
from changelake.operators.audit import capture_changes, check_key, pending, publish_envelope, publish_records, unpublished
from changelake.operators.digests import TreeShape, capture_by_ranges, write_digests
from changelake.operators.envelope import add_date_parts, decode_envelope, flag_bad
from changelake.operators.joins import member_join
from changelake.operators.keys import key_table
from changelake.operators.member_index import member_index_join
from changelake.operators.netchange import net_changes
from changelake.operators.offsets import PARTITION, committed_offsets, offset_gaps, offset_ranges
from changelake.operators.rowevents import (
    classify_row_events,
    drop_no_event,
    explode_rows,
    lookup_table_map,
    lookup_table_map_static,
    raw_stream_form,
    row_event_json,
)
from changelake.plans import fixtures as fx
from changelake.plans.jobs import (
    audit_publisher, capture_job, lake_consumer, poll_audit_once, poll_audit_runs, read_audit_folder, row_log_publisher,
    snapshot_lake_consumer,
)
from changelake.schemas import PUBLISH, ROW_EVENT_MESSAGE
from changelake.session import scratch_path
from changelake.sinks.lake import CAPTURE_COLUMN, append_audit, ensure_table, register_lake, remove_path, write_lake
from changelake.sinks.ledger import publish_and_ack, read_ledger
from changelake.sinks.redrive import MessageVersion, Redrive
from changelake.sinks.runs import RunLedger
from changelake.sinks.snapshots import SnapshotLake
from changelake.sources.files import read_lake, read_row_events
from changelake.sources.kafka import read_json_topic
from changelake.sources.synth import synth_transactions
from changelake.streaming.dedup import drop_redelivered_ledger, drop_redelivered_stream
from changelake.streaming.lake_stream import run_to_end, write_lake_stream
from changelake.streaming.metrics import counted_batches, read_counts
from changelake.streaming.table_map import table_map_stream
from changelake.streaming.table_map_late import current_answers, late_map_stream

Query = Callable[[SparkSession, str], DataFrame]

ASOF_BUCKET_WIDTH = 4096   # positions per as-of scan bucket in the registered queries
ORDERED_LANDINGS = 4  # landings of the ordered streams
REDELIVERED_LOTS = 3  # landings of the re-delivered messages
LANDED_LOTS = 3  # lots of files in each landing of the ledger's messages
ORDER_MESSAGE_VERSIONS = (
    MessageVersion("renamed", "$.payload.old", "$.payload.new", "$.payload.kind", "$.payload.at", {"o_totalprice": "price"}),
    MessageVersion("change", "$.change.before", "$.change.after", "$.change.op", "$.change.ts_ms"),
)


def _flat(prefix: str, struct_col: str, fields) -> list:
    return [F.col(f"{struct_col}.{f}").alias(f"{prefix}_{f}") for f in fields]


# ------------------------------------------------------------- envelopes ---

def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.order_envelopes(fx.table(spark, sf_dir, "orders"))
    dec = decode_envelope(msgs, fx.ORDER_ENVELOPE_ROW)
    names = fx.ORDER_ENVELOPE_ROW.fieldNames()
    return dec.select(*_flat("before", "before", names), *_flat("after", "after", names), "op", "ts_ms")


def _decoded_orders_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.order_envelopes(fx.table(spark, sf_dir, "orders"))
    return add_date_parts(decode_envelope(msgs, fx.ORDER_ENVELOPE_ROW), "ts_ms", tz="UTC")


def date_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode -> date parts -> partitioned Parquet lake -> read back -> counts."""
    lake = scratch_path(spark, "orders-lake")
    write_lake(_decoded_orders_with_dates(spark, sf_dir), lake)
    return (
        read_lake(spark, lake)
        .groupBy("year", "month", "day", "op")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _events_with_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.withColumns({"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})


def lake_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write events to the lake, read two weeks of it back through partition filters."""
    lake = scratch_path(spark, "events-lake")
    write_lake(_events_with_dates(spark, sf_dir), lake)
    return read_lake(spark, lake, start="2024-01-08", end="2024-01-21").select(
        "event_id", "user_id", "event_type", "value", "year", "month", "day"
    )


def stream_append_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stream of the events table -> date parts -> streamed Parquet lake."""
    schema = fx.table(spark, sf_dir, "events").schema
    src = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", "64")
        .parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")  # a pattern takes in one file or a folder of files
    )
    dated = src.withColumns({"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})
    root = scratch_path(spark, "stream-lake")
    q = write_lake_stream(dated, f"{root}/lake", f"{root}/checkpoint", trigger={"availableNow": True})
    run_to_end(q)
    return spark.read.parquet(f"{root}/lake").select(
        "event_id", "ts", "user_id", "event_type", "value", "props", "year", "month", "day"
    )


def bad_message_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once: good rows decoded, bad ones flagged with a reason."""
    msgs = fx.event_messages(fx.table(spark, sf_dir, "events"), truncate_type="error", spoil_type="signup")
    flagged = flag_bad(msgs, fx.EVENT_ENVELOPE_ROW, keep=("key",))
    good = F.col("bad_reason").isNull()
    return flagged.select(
        "key",
        F.when(good, F.lit("good")).otherwise(F.lit("bad")).alias("status"),
        F.col("bad_reason").alias("reason"),
        F.when(good, F.col("after.event_type")).alias("event_type"),
    )


def json_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple JSON messages landed as topic records -> streamed decode; messages
    without a value or cut short are flagged."""
    msgs = fx.simple_messages(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "json-topic")
    msgs.write.parquet(f"{root}/in")
    records = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
    decoded = read_json_topic(records, T.StructType().add("k", "long"), keep=("key",), flag=True)
    run_to_end(decoded.writeStream.format("parquet").option("path", f"{root}/out")
               .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{root}/out").select("key", "k", F.col("bad_reason").alias("reason"))


def json_field_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", json_field("props", "k", "bigint").alias("k"))


# --------------------------------------------------------------- publish ---

def publish_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fx.order_inserts(fx.table(spark, sf_dir, "orders"))
    rec = publish_records(audit, ts_is_ntz=True)
    return rec.select("record_id", "operation", "hash_id", "hash_pk", "hash_record", "timestamp_epoch", "data")


def publish_envelope_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fx.order_audit(fx.table(spark, sf_dir, "orders"))
    return publish_envelope(audit).select("key", "value", "topic")


def pending_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    flag = (
        F.when(F.col("event_type") == "purchase", F.lit(True))
        .when(F.col("event_type") == "view", F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )
    return pending(ev.withColumn("is_in_kafka", flag)).select("event_id", "event_type")


# ----------------------------------------------------------------- audit ---

_AUDIT_OUT = ("audit_log_id", "db_name", "table_name", "record_id", "operation", "old_data", "new_data",
              "is_in_kafka")


def audit_capture_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.order_audit(fx.table(spark, sf_dir, "orders")).select(*_AUDIT_OUT)


def audit_capture_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["o_orderstatus", "o_totalprice"]
    return fx.order_audit(fx.table(spark, sf_dir, "orders"), cols=cols).select(*_AUDIT_OUT)


def audit_capture_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture of versions that differ in few key ranges: digest trees find the ranges, the rest is not joined."""
    root = scratch_path(spark, "range-capture")
    old, new = fx.order_rare_versions(fx.table(spark, sf_dir, "orders"))
    shape = TreeShape.of(new, "o_orderkey", width=fx.RARE_WIDTH)
    write_digests(old, shape, f"{root}/old")
    return capture_by_ranges(old, new, "o_orderkey", f"{root}/old", f"{root}/new", shape, db_name=fx.DB_NAME,
                             table_name=fx.ORDERS_TABLE, captured_at=fx.captured_at(), version=fx.VERSION).select(*_AUDIT_OUT)


def unpublished_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the audit rows to the audit table (written once, in the shared
    folder), publish those of fulfilled orders (acknowledged into a ledger),
    then list the rows still unpublished."""
    root = scratch_path(spark, "unpublished")
    append_audit(fx.order_audit(fx.table(spark, sf_dir, "orders")), f"{root}/audit")
    audit = spark.read.parquet(f"{root}/audit")
    status = F.get_json_object(F.coalesce("new_data", "old_data"), "$.o_orderstatus")
    first_batch = audit.filter(status == "F")

    def send(batch: DataFrame) -> None:  # topic stand-in: render and discard
        publish_envelope(batch).write.format("noop").mode("overwrite").save()

    publish_and_ack(first_batch, 0, send, f"{root}/ledger")
    return unpublished(audit, read_ledger(spark, f"{root}/ledger")).select("audit_log_id", "record_id", "operation")


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated order keys of line items; the seventh lines have lost theirs."""
    lost = F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("l_orderkey")
    return check_key(fx.table(spark, sf_dir, "lineitem").select(lost), "l_orderkey")


def member_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        "o_orderpriority",
        F.sequence(F.lit(1), F.substring("o_orderpriority", 1, 1).try_cast("int")).alias("key_lines"),
    )
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey"
    )
    out = member_join(orders, lines, "orderkey", "l_linenumber", "key_lines")
    return out.select("orderkey", "o_orderpriority", "l_linenumber", "l_partkey")


# ------------------------------------------------------------ row events ---

def table_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps, rows = fx.event_maps_and_rows(fx.table(spark, sf_dir, "events"))
    out = lookup_table_map(rows, maps, bucket_width=ASOF_BUCKET_WIDTH)
    return out.select("position", "table_id", F.col("database").alias("db_name"),
                      F.col("table").alias("table_name"))


def table_map_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("table_id"))
    maps = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("table_id"), F.col("c_mktsegment").alias("database"),
        F.col("c_name").alias("table"),
    )
    out = lookup_table_map_static(ev, maps)
    return out.select("event_id", "table_id", F.col("database").alias("db_name"),
                      F.col("table").alias("table_name"))


def row_event_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.lineitem_row_events(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"))
    rows = explode_rows(events)
    return rows.select(F.col("event_type").alias("event"), row_event_json(rows).alias("message"))


def row_event_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unquoted message form; the database of DELETE events is unknown."""
    events = fx.lineitem_row_events(fx.table(spark, sf_dir, "orders"), fx.table(spark, sf_dir, "lineitem"))
    rows = explode_rows(events.withColumn("database", F.when(F.col("event_type") != "DELETE", F.col("database"))))
    return rows.select(F.col("event_type").alias("event"), row_event_json(rows, raw=True).alias("message"))


def row_event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = classify_row_events(drop_no_event(fx.raw_event_feed(fx.table(spark, sf_dir, "events"))))
    return raw_stream_form(feed.filter(F.col("kind") == "row"), with_time=False)


def changelog_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by key as a topic would; the three forms share this one exchange of the orders
    orders = fx.table(spark, sf_dir, "orders").repartition("o_orderkey")
    env = cl.from_envelope(decode_envelope(fx.order_envelopes(orders), fx.ORDER_ENVELOPE_ROW),
                           fx.DB_NAME, fx.ORDERS_TABLE, "o_orderkey")
    pub_msgs = publish_envelope(fx.order_inserts(orders), ts_is_ntz=True)
    pub = cl.from_publish(pub_msgs.select(F.from_json("value", PUBLISH).alias("m")).select("m.*"))
    exploded = explode_rows(fx.order_row_events(orders))
    row_msgs = exploded.select(row_event_json(exploded).alias("value"))
    rev = cl.from_row_events(row_msgs.select(F.from_json("value", ROW_EVENT_MESSAGE).alias("m")).select("m.*"))
    return cl.to_changelog(env, pub, rev)


# ------------------------------------------------------------- streaming ---

def dedup_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published at least once (purchases sent twice) -> streamed dedup
    on the message id, over several micro-batches.  Messages are dealt to
    files without regard to their time, and copies to different files, so
    late unique messages and copies that cross batches both occur."""
    ev = fx.table(spark, sf_dir, "events")
    msgs = ev.select(F.col("event_id").cast("string").alias("audit_log_id"), "ts", "event_type", "value")
    sent = msgs.withColumn("_copy", F.explode(F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1)))
                                              .otherwise(F.array(F.lit(0)))))
    root = scratch_path(spark, "redelivered")
    lot = F.pmod(F.xxhash64("audit_log_id") + F.col("_copy"), F.lit(REDELIVERED_LOTS))
    sent.withColumn("_lot", lot).drop("_copy").write.partitionBy("_lot").parquet(f"{root}/sent")
    for k in range(REDELIVERED_LOTS):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == k).drop("_lot").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
        arrived = src.withColumn("_landed", F.col("_metadata.file_modification_time"))
        q = (
            drop_redelivered_stream(arrived, "_landed").writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        run_to_end(q)
    return spark.read.parquet(f"{root}/out").select("audit_log_id", "event_type", "value")


def dedup_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, some without an id, in two landings of files, streamed by a processing-time trigger with a
    bounded number of files a batch; a ledger of runs is the memory and a lake of snapshots the target.  The first
    run after each landing is lost between the two."""
    ev = fx.table(spark, sf_dir, "events")
    has_id = F.col("event_type") != "signup"
    msgs = ev.select(F.when(has_id, F.col("event_id").cast("string")).alias("audit_log_id"), "event_type", "value",
                     F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    root = scratch_path(spark, "dedup-ledger")
    lot = F.pmod(F.xxhash64("audit_log_id", "value") + F.col("_copy"), F.lit(2 * LANDED_LOTS))
    sent = msgs.withColumn("_copy", F.explode(copies)).withColumn("_lot", lot).drop("_copy")
    sent.write.partitionBy("_lot").parquet(f"{root}/sent")
    lake, ledger = SnapshotLake(spark, f"{root}/lake", msgs.schema), RunLedger(spark, f"{root}/ledger", fanout=2)
    lost: list[int] = []

    def sink(rows: DataFrame, batch_id: int) -> None:
        lake.append(rows, batch_id)
        if len(lost) < landing + 1:
            lost.append(batch_id)
            raise OSError("lost between lake and ledger")

    for landing in (0, 1):
        spark.read.parquet(f"{root}/sent").where(F.floor(F.col("_lot") / LANDED_LOTS) == landing).drop("_lot").write.mode("append").parquet(f"{root}/in")
        files = len(spark.read.schema(msgs.schema).parquet(f"{root}/in").inputFiles())
        src = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", str(-(-files // 3))).parquet(f"{root}/in")
        for _ in range(2):
            q = drop_redelivered_ledger(src, sink, ledger, f"{root}/checkpoint", trigger={"processingTime": "0 seconds"})
            try:
                q.processAllAvailable()
            except StreamingQueryException:
                if "lost between lake and ledger" not in str(q.exception()):
                    raise
            finally:
                q.stop()
    return lake.read()


def _stream_in_order(records: DataFrame, dest: str, stream: Callable[[], StreamingQuery]) -> None:
    """Land records in ``ORDERED_LANDINGS`` ranges of position, each in one job
    with as many files as it has tasks, and run the stream up to the end after
    each: order matters between micro-batches only, and the number of jobs
    does not grow with the rows."""
    spark = records.sparkSession
    bounds = records.agg(F.min("position").alias("lo"), F.max("position").alias("hi")).first()
    lo, hi = bounds["lo"] or 0, bounds["hi"] or 0
    step = (hi - lo) // ORDERED_LANDINGS + 1
    for k in range(ORDERED_LANDINGS):
        part = records.where(F.col("position").between(lo + k * step, lo + (k + 1) * step - 1))
        part.write.mode("append").parquet(dest)
        run_to_end(stream())


def table_map_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records arrive in ranges of position; each micro-batch carries the
    table map forward to the next."""
    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "table-map-stream")
    _stream_in_order(records, f"{root}/in", lambda: table_map_stream(
        read_row_events(spark, f"{root}/in", stream=True), f"{root}/out", f"{root}/state", f"{root}/checkpoint",
        bucket_width=ASOF_BUCKET_WIDTH, trigger={"availableNow": True}))
    out = spark.read.parquet(f"{root}/out")
    return out.select("position", "table_id", F.col("database").alias("db_name"),
                      F.col("table").alias("table_name"))


def envelope_stream_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic -> lake job on order envelopes landed as files: streamed decode,
    quarantine split, date parts, partitioned file sink; read back flat."""
    msgs = fx.order_envelopes(fx.table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "envelope-stream")
    # landed by key, as a topic's partitions are
    msgs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "value").write.parquet(f"{root}/in")
    src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
    run_to_end(*lake_consumer(src, f"{root}/lake", f"{root}/checkpoint", row_schema=fx.ORDER_ENVELOPE_ROW,
                              aliases=None, trigger={"availableNow": True}, day_spread=2))
    names = fx.ORDER_ENVELOPE_ROW.fieldNames()
    return spark.read.parquet(f"{root}/lake").select(
        *_flat("before", "before", names), *_flat("after", "after", names), "op", "ts_ms", "year", "month", "day"
    )


def audit_publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture job appends audit rows; the publisher stream sends them as
    topic records and acknowledges them in the ledger."""
    root = scratch_path(spark, "audit-publish")
    old, new = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    capture_job(old, new, "o_orderkey", f"{root}/audit", db_name=fx.DB_NAME, table_name=fx.ORDERS_TABLE,
                captured_at=fx.captured_at(), version=fx.VERSION)

    def send(batch: DataFrame) -> None:
        batch.select("key", "value", "topic").write.mode("append").parquet(f"{root}/topic")

    run_to_end(audit_publisher(spark, f"{root}/audit", send, f"{root}/ledger", f"{root}/checkpoint",
                               trigger={"availableNow": True}))
    return spark.read.parquet(f"{root}/topic")


def row_log_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-log job: landed events (table maps + inserts) in position order ->
    carried table-map lookup -> one JSON message per row with a constant key."""
    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "row-log")

    def send(batch: DataFrame) -> None:
        batch.write.mode("append").parquet(f"{root}/topic")

    _stream_in_order(records, f"{root}/in", lambda: row_log_publisher(
        read_row_events(spark, f"{root}/in", stream=True), f"{root}/state", f"{root}/checkpoint", send,
        trigger={"availableNow": True}, bucket_width=ASOF_BUCKET_WIDTH))
    return spark.read.parquet(f"{root}/topic")


def lake_and_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake job on order messages of which some are unusable in every known
    way, landed in two lots with a restart between; lake and quarantine read back together."""
    msgs = fx.order_messages(fx.table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "lake-quarantine")
    msgs.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(2))).hint("rebalance", "_lot").write.partitionBy("_lot").parquet(f"{root}/sent")
    for lot in (0, 1):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == lot).drop("_lot").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
        run_to_end(*lake_consumer(src, f"{root}/lake", f"{root}/checkpoint", row_schema=fx.ORDER_ENVELOPE_ROW, aliases=None,
                                  trigger={"availableNow": True}, keep=("key",), day_spread=2))
    lake = spark.read.parquet(f"{root}/lake").select(
        "key", F.lit(None).cast("string").alias("reason"), "op", "ts_ms", F.col("after.o_totalprice").alias("after_totalprice"),
        "year", "month", "day")
    bad = spark.read.parquet(f"{root}/lake_quarantine").select("key", F.col("bad_reason").alias("reason"))
    return lake.unionByName(bad, allowMissingColumns=True)


def quarantine_redrive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages of three schemas through the lake job in two landings; the quarantine driven again after each by the
    versions known then, the second time over a run lost before it was closed; lake and quarantine read back together."""
    msgs = fx.order_messages_by_version(fx.table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "quarantine-redrive")
    msgs.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(2))).hint("rebalance", "_lot").write.partitionBy("_lot").parquet(f"{root}/sent")
    redrive = Redrive(spark, f"{root}/lake", f"{root}/lake_quarantine", f"{root}/redrive")

    def lost() -> None:
        raise OSError("lost before the run was closed")

    for lot in (0, 1):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == lot).drop("_lot").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
        run_to_end(*lake_consumer(src, f"{root}/lake", f"{root}/checkpoint", row_schema=fx.ORDER_ENVELOPE_ROW, aliases=None,
                                  trigger={"availableNow": True}, keep=("key",), day_spread=2))
        try:
            redrive.run(fx.ORDER_ENVELOPE_ROW, ORDER_MESSAGE_VERSIONS[:lot + 1], ("key",), before_close=lost if lot else None)
        except OSError:
            redrive.run(fx.ORDER_ENVELOPE_ROW, ORDER_MESSAGE_VERSIONS, ("key",))
    lake = spark.read.parquet(f"{root}/lake").select(
        "key", F.lit(None).cast("string").alias("reason"), "op", "ts_ms", F.col("before.o_custkey").alias("before_custkey"),
        F.col("after.o_totalprice").alias("after_totalprice"), "year", "month", "day")
    bad = redrive.read_quarantine().select("key", F.col("bad_reason").alias("reason"))
    return lake.unionByName(bad, allowMissingColumns=True)


def lake_sql_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake registered as a table of the session's catalog, and a table
    created from a schema (twice: the second time it is there) and filled
    from it with SQL; both joined per day."""
    root = scratch_path(spark, "lake-table")
    name = "t_" + root.rsplit("-", 1)[1]
    write_lake(_events_with_dates(spark, sf_dir), f"{root}/lake")
    register_lake(spark, f"lake_{name}", f"{root}/lake")
    days = T.StructType().add("year", "integer").add("month", "integer").add("day", "integer").add("n", "long")
    for _ in range(2):
        ensure_table(spark, f"days_{name}", days, path=f"{root}/days")
    spark.sql(f"INSERT INTO days_{name} SELECT year, month, day, count(*) FROM lake_{name} GROUP BY year, month, day")
    return spark.sql(f"""
      SELECT l.event_type, d.year, d.month, d.day, count(*) AS n, max(d.n) AS day_n
      FROM lake_{name} l JOIN days_{name} d ON l.year = d.year AND l.month = d.month AND l.day = d.day
      GROUP BY l.event_type, d.year, d.month, d.day""")


def audit_publish_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of two tables in one audit folder -> one publisher -> a topic per table."""
    root = scratch_path(spark, "audit-many")
    tables = {fx.ORDERS_TABLE: ("o_orderkey", fx.order_versions), "customer": ("c_custkey", fx.customer_versions)}
    for name, (key, versions) in tables.items():
        old, new = versions(fx.table(spark, sf_dir, name))
        capture_job(old, new, key, f"{root}/audit", db_name=fx.DB_NAME, table_name=name,
                    captured_at=fx.captured_at(), version=fx.VERSION)

    def send(batch: DataFrame) -> None:
        batch.select("key", "value", "topic").write.mode("append").parquet(f"{root}/topic")

    run_to_end(audit_publisher(spark, f"{root}/audit", send, f"{root}/ledger", f"{root}/checkpoint",
                               trigger={"availableNow": True}))
    return spark.read.parquet(f"{root}/topic")


def _with_poll(audit: DataFrame, topic: DataFrame) -> DataFrame:
    """Audit rows with the poll that sent them, joined on packed ids."""
    key = packed_id(F.col("audit_log_id")).alias("_key")
    rows = audit.select(key, "record_id", "operation", "new_data").join(topic.select(key, "poll"), "_key", "left")
    return rows.select(unpacked_id(F.col("_key")).alias("audit_log_id"), "record_id", "operation", "new_data", "poll")


def audit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three successive versions of the orders captured into one audit table, the
    second capture run twice, and polls that publish after each run: every
    change once, with the poll that sent it."""
    root = scratch_path(spark, "audit-versions")
    first, second = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    third = fx.order_third_version(second)
    for poll, (old, new, version) in enumerate([(first, second, "v2"), (second, third, "v3"), (second, third, "v3")]):
        capture_job(old, new, "o_orderkey", f"{root}/audit", db_name=fx.DB_NAME, table_name=fx.ORDERS_TABLE,
                    captured_at=fx.captured_at(), version=version)

        def send(batch: DataFrame, poll: int = poll) -> None:
            batch.withColumn("poll", F.lit(poll)).write.mode("append").option("compression", "zstd").parquet(f"{root}/topic")

        poll_audit_once(spark.read.parquet(f"{root}/audit"), send, f"{root}/ledger")
    return _with_poll(spark.read.parquet(f"{root}/audit"), spark.read.parquet(f"{root}/topic"))


def audit_capture_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same versions, each capture in a folder of its own and polled into a ledger of runs: a third of the last
    capture's rows lie there from a run lost before its mark when it is polled, then it runs whole, and again."""
    root = scratch_path(spark, "capture-once")
    first, second = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    third = fx.order_third_version(second)
    shape = {"db_name": fx.DB_NAME, "table_name": fx.ORDERS_TABLE, "captured_at": fx.captured_at()}
    ledger = RunLedger(spark, f"{root}/ledger")

    def lost_run() -> None:
        part = capture_changes(second, third, "o_orderkey", version="v3", **shape).where(F.col("record_id").cast("long") % 3 == 0)
        at = f"{root}/audit/{CAPTURE_COLUMN}={fx.DB_NAME}.{fx.ORDERS_TABLE}.v3"
        part.write.parquet(at)
        remove_path(spark, f"{at}/_SUCCESS")

    def capture(old: DataFrame, new: DataFrame, version: str) -> None:
        capture_job(old, new, "o_orderkey", f"{root}/audit", version=version, own_folder=True, **shape)

    steps = (lambda: capture(first, second, "v2"), lost_run, lambda: capture(second, third, "v3"), lambda: capture(second, third, "v3"))
    for poll, step in enumerate(steps):
        step()

        def send(batch: DataFrame, poll: int = poll) -> None:
            batch.withColumn("poll", F.lit(poll)).write.mode("append").option("compression", "zstd").parquet(f"{root}/topic")

        poll_audit_runs(read_audit_folder(spark, f"{root}/audit"), send, ledger, tick=poll)
    return _with_poll(read_audit_folder(spark, f"{root}/audit"), spark.read.parquet(f"{root}/topic"))


LEDGER_POLLS = 6


def audit_ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of an audit table that grows between them, against a ledger of sorted runs: each poll sees all rows
    so far and sends those no run holds; runs are merged on the way, one merge is lost before its commit and one
    tick is polled twice.  Every change with the poll that sent it."""
    root = scratch_path(spark, "ledger-runs")
    fx.order_audit(fx.table(spark, sf_dir, "orders")).write.parquet(f"{root}/audit")
    audit = spark.read.parquet(f"{root}/audit")
    ledger = RunLedger(spark, f"{root}/ledger", fanout=2)

    def lost() -> None:
        raise OSError("lost before the commit")

    for poll in range(LEDGER_POLLS):
        def send(batch: DataFrame, poll: int = poll) -> None:
            batch.withColumn("poll", F.lit(poll)).write.mode("append").option("compression", "zstd").parquet(f"{root}/topic")

        so_far = audit.where(F.col("record_id").cast("long") % LEDGER_POLLS <= poll)
        poll_audit_runs(so_far, send, ledger, tick=poll)
        if poll == 2:
            poll_audit_runs(so_far, send, ledger, tick=poll)
        if poll == 3:
            ledger.append(ledger.ids().limit(0), LEDGER_POLLS + 100, merge=False)
            ledger.append(ledger.ids().limit(0), LEDGER_POLLS + 101, merge=False)
            try:
                ledger.merge(lost)
            except OSError:
                ledger.vacuum()
    held = packed_id(F.col("audit_log_id")).alias("_key")
    sent = spark.read.parquet(f"{root}/topic").select(held, "key", "poll").join(ledger.ids().select(held), "_key")
    return sent.select(unpacked_id(F.col("_key")).alias("audit_log_id"), "key", "poll")


def lake_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages streamed into a lake of snapshots in three landings with restarts; compactions between, one
    of them lost before its commit; a two-month range of ``ts_ms`` read back through the zone maps."""
    msgs = fx.order_messages(fx.table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "lake-snapshots")
    msgs.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(3))).hint("rebalance", "_lot").write.partitionBy("_lot").parquet(f"{root}/sent")
    rows = decode_envelope(msgs, fx.ORDER_ENVELOPE_ROW, keep=("key",))
    lake = SnapshotLake(spark, f"{root}/lake", add_date_parts(rows, "ts_ms").schema, zones=("ts_ms",))

    def lost() -> None:
        raise OSError("lost before the swap")

    for lot in range(3):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == lot).drop("_lot").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
        run_to_end(snapshot_lake_consumer(src, lake, f"{root}/bad", f"{root}/checkpoint", row_schema=fx.ORDER_ENVELOPE_ROW, aliases=None,
                                          trigger={"availableNow": True}, keep=("key",)))
        if lot:
            try:
                lake.compact(lost if lot == 1 else None)
            except OSError:
                lake.vacuum()
    return lake.read(within={"ts_ms": fx.LAKE_RANGE_MS}).select(
        "key", "op", "ts_ms", F.col("after.o_totalprice").alias("after_totalprice"), "year", "month", "day")


def net_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net change of each record over a changelog of three message forms, a third of it on one record."""
    envelopes, published, row_events = fx.event_change_forms(fx.table(spark, sf_dir, "events"))
    log = cl.to_changelog(cl.from_envelope(envelopes, fx.DB_NAME, "records", "k"), cl.from_publish(published),
                          cl.from_row_events(row_events, ts_ms="at_ms"))
    return net_changes(log, "record_key", "ts_ms", width=1 << 20, keep_nothing=True)


def offset_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges, gaps, repeats and committed offset of a topic's landed records, with planted gaps and replays."""
    ranges = offset_ranges(fx.event_offsets(fx.table(spark, sf_dir, "events")), width=4096)
    path = scratch_path(spark, "offset-ranges")
    ranges.write.parquet(path)
    ranges = spark.read.schema(ranges.schema).parquet(path)
    gaps = offset_gaps(ranges, begin=0).select(*PARTITION, F.lit("gap").alias("kind"), "lo", "hi")
    full = ranges.select(*PARTITION, F.lit("landed").alias("kind"), "lo", "hi", "n_records", "n_repeated")
    return full.unionByName(gaps, allowMissingColumns=True).join(committed_offsets(ranges, begin=0), list(PARTITION))


def row_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw row-log records streamed in two lots with a restart; rows, ignored, unhandled and bad ones counted while they
    are written, the stored counts summed up."""
    feed = classify_row_events(fx.raw_event_feed(fx.table(spark, sf_dir, "events")))
    # updates without their after-image
    broken = (F.col("event_type") == "UPDATE") & (F.col("position") % 10 == 0)
    feed = feed.withColumn("rows_after", F.when(~broken, F.col("rows_after"))).withColumn("kind", F.when(broken, F.lit("bad")).otherwise(F.col("kind")))
    root = scratch_path(spark, "event-counts")
    feed.withColumn("_lot", F.pmod(F.xxhash64("position"), F.lit(2))).write.partitionBy("_lot").parquet(f"{root}/sent")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    run = counted_batches(write, f"{root}/counts", "kind", ("row", "map", "ignored", "unhandled", "bad"))
    for lot in (0, 1):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == lot).drop("_lot").write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema(feed.schema).parquet(f"{root}/in")
        run_to_end(src.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return read_counts(spark, f"{root}/counts").groupBy("kind").agg(F.sum("n").alias("n")).where("n > 0")


def table_map_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed records in three lots without regard to position: late map records take answers back and give them anew."""
    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "table-map-late")
    records.withColumn("_lot", F.pmod(F.xxhash64("position"), F.lit(3))).write.partitionBy("_lot").parquet(f"{root}/sent")
    for lot in range(3):
        spark.read.parquet(f"{root}/sent").where(F.col("_lot") == lot).drop("_lot").write.mode("append").parquet(f"{root}/in")
        run_to_end(late_map_stream(read_row_events(spark, f"{root}/in", stream=True), f"{root}/state", f"{root}/checkpoint",
                                   bucket_width=ASOF_BUCKET_WIDTH, trigger={"availableNow": True}))
    return current_answers(spark, f"{root}/state").select("position", "table_id", F.col("database").alias("db_name"),
                                                          F.col("table").alias("table_name"))


def key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minimal keys of up to three columns of two tables that name none."""
    lines, events = (key_table(fx.table(spark, sf_dir, t), t) for t in fx.KEY_TABLES)
    return lines.unionByName(events)


def member_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, many of one nation, with a list of a thousand customer keys each; customers of the nation that are in it."""
    suppliers = fx.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), "s_suppkey", F.sequence(F.col("s_suppkey"), F.col("s_suppkey") + 999).alias("members"))
    customers = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", "c_name")
    return member_index_join(suppliers, customers, "nation", "c_custkey", "members", "left").drop("members")


def synth_transactions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return synth_transactions(ids, "id", seed=42)


QUERIES: dict[str, Query] = {
    "envelope_decode": envelope_decode,
    "date_partition_counts": date_partition_counts,
    "lake_month_scan": lake_month_scan,
    "stream_append_lake": stream_append_lake,
    "bad_message_split": bad_message_split,
    "json_field": json_field_query,
    "json_topic": json_topic,
    "publish_keys": publish_keys,
    "publish_envelope": publish_envelope_query,
    "pending_filter": pending_filter,
    "audit_capture_full": audit_capture_full,
    "audit_capture_subset": audit_capture_subset,
    "audit_capture_ranges": audit_capture_ranges,
    "unpublished_antijoin": unpublished_antijoin,
    "key_violations": key_violations,
    "member_join": member_join_query,
    "table_map_lookup": table_map_lookup,
    "table_map_static": table_map_static,
    "row_event_explode": row_event_explode,
    "row_event_raw": row_event_raw,
    "row_event_filter": row_event_filter,
    "changelog_union": changelog_union,
    "dedup_redelivered": dedup_redelivered,
    "dedup_ledger": dedup_ledger,
    "table_map_stream": table_map_stream_query,
    "synth_transactions": synth_transactions_query,
    "envelope_stream_lake": envelope_stream_lake,
    "audit_publish_stream": audit_publish_stream,
    "row_log_publish": row_log_publish,
    "lake_and_quarantine": lake_and_quarantine,
    "quarantine_redrive": quarantine_redrive,
    "lake_sql_table": lake_sql_table,
    "audit_publish_many": audit_publish_many,
    "audit_versions": audit_versions,
    "audit_capture_once": audit_capture_once,
    "audit_ledger_runs": audit_ledger_runs,
    "lake_snapshots": lake_snapshots,
    "net_change": net_change,
    "key_discovery": key_discovery,
    "member_index": member_index,
    "offset_coverage": offset_coverage,
    "row_event_counts": row_event_counts,
    "table_map_late": table_map_late,
}
