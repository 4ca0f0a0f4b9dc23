"""The reference's three pipelines as Spark jobs, composed from the operators.

* :func:`lake_consumer`      change envelopes (topic or files) -> date-partitioned lake
* :func:`capture_job`        two table versions -> appended audit rows
* :func:`audit_publisher`    audit rows (streamed from the audit folder) -> topic, with ledger
* :func:`poll_audit_once`    one poll of a database audit table -> topic, with ledger
* :func:`poll_audit_runs`    the same with a ledger of sorted runs
* :func:`row_log_publisher`  landed row-log events -> one JSON message per row -> topic
* :func:`row_log_console`    landed row-log events -> console (raw whole-event form)

Command line (cluster settings come from spark-submit)::

    zip -r changelake.zip changelake
    spark-submit --py-files changelake.zip changelake/plans/jobs.py lake-consumer \\
        --servers B --topic T --lake L --checkpoint C
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.audit import capture_changes, pending, publish_envelope, publish_source, unpublished
from changelake.operators.envelope import add_date_parts, bad_rows, flag_bad, good_rows
from changelake.operators.rowevents import explode_rows, raw_stream_form, row_event_json
from changelake.schemas import AUDIT, TRANSACTION_ALIASES, TRANSACTION_ROW
from changelake.session import apply_recommended
from changelake.sinks.lake import append_audit, append_capture, write_console, write_quarantine
from changelake.sinks.ledger import next_batch_id, publish_and_ack, read_ledger
from changelake.sinks.runs import RunLedger, publish_once
from changelake.sinks.snapshots import SnapshotLake
from changelake.sources.files import read_row_events
from changelake.sources.jdbc import read_audit
from changelake.sources.kafka import read_topic, write_topic
from changelake.streaming.lake_stream import DEFAULT_TRIGGER, held_batch, split_lake_stream
from changelake.streaming.publish import publish_stream
from changelake.streaming.table_map import table_map_stream

# Fixed values of the row-log publisher.
ROW_LOG_TOPIC = "mysql.binlog.events"
ROW_LOG_KEY = "default_key"


def lake_consumer(records: DataFrame, lake: str, checkpoint: str, quarantine: str | None = None,
                  row_schema: T.StructType = TRANSACTION_ROW, aliases=TRANSACTION_ALIASES,
                  tz: str = "UTC", trigger: dict | None = None, day_spread: int | None = None,
                  keep: tuple[str, ...] = ()) -> list[StreamingQuery]:
    """Decode envelopes, add date parts in ``tz``, append to the lake.

    Unusable messages go to ``quarantine`` (default ``<lake>_quarantine``)
    rather than to an all-null row in a default date partition.  One query
    writes both, so they start at the same offsets and no message is in
    neither.  ``keep`` names columns of ``records`` to carry along.
    """
    flagged = flag_bad(records, row_schema, keep=keep, aliases=aliases)
    return [split_lake_stream(flagged, lambda rows: add_date_parts(good_rows(rows, keep), "ts_ms", tz),
                              lambda rows: bad_rows(rows, keep), lake, quarantine or f"{lake.rstrip('/')}_quarantine",
                              checkpoint, trigger=trigger, day_spread=day_spread)]


def kafka_lake_consumer(spark: SparkSession, servers: str, topic: str, lake: str, checkpoint: str,
                        max_offsets_per_trigger: int | None = None, **kw) -> list[StreamingQuery]:
    """Topic (from latest offsets when new) -> lake."""
    records = read_topic(spark, servers, topic, "latest", max_offsets_per_trigger=max_offsets_per_trigger)
    return lake_consumer(records, lake, checkpoint, **kw)


def capture_job(old: DataFrame, new: DataFrame, key: str | list[str], audit_path: str,
                cols: list[str] | None = None, db_name: str = "db", table_name: str = "table",
                captured_at: Column | None = None, version: str | None = None, own_folder: bool = False) -> None:
    """Append the audit rows between two versions of a table.

    With ``own_folder`` they go to a folder of their table and ``version``, and a capture that is run again reads nothing
    of the audit table (see :func:`append_capture`)."""
    audit = capture_changes(old, new, key, cols=cols, db_name=db_name, table_name=table_name,
                            captured_at=captured_at, version=version)
    if own_folder:
        if version is None:
            raise ValueError("a capture's own folder is named by its version")
        append_capture(audit, audit_path, f"{db_name}.{table_name}.{version}")
    else:
        append_audit(audit, audit_path)


def topic_sender(servers: str) -> Callable[[DataFrame], None]:
    """Batch writer of ``key, value, topic`` records."""
    return lambda df: write_topic(df, servers)


def audit_publisher(spark: SparkSession, audit_path: str, send: Callable[[DataFrame], None], ledger: str,
                    checkpoint: str, trigger: dict | None = None, max_files_per_trigger: int | None = None,
                    **kw) -> StreamingQuery:
    """Stream the audit folder (every 5 s by default) into the topic sender.

    All tables share one query: the topic is ``kfk_stream_<table_name>``.
    """
    r = spark.readStream.schema(AUDIT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return publish_stream(r.parquet(audit_path), send, ledger, checkpoint, trigger=trigger, **kw)


def read_audit_folder(spark: SparkSession, path: str) -> DataFrame:
    """The audit rows of a folder, whether or not captures have folders of their own."""
    return spark.read.schema(AUDIT).parquet(path).select(*AUDIT.fieldNames())


def poll_audit_once(audit: DataFrame, send: Callable[[DataFrame], None], ledger: str, tick: int | None = None,
                    **kw) -> None:
    """One poll of an audit table (e.g. ``sources.jdbc.read_audit``): pending
    rows not yet in the ledger are published and acknowledged under ``tick``
    (the ledger's next one when None; a used one is refused)."""
    spark = audit.sparkSession
    tick = next_batch_id(spark, ledger) if tick is None else tick
    todo = unpublished(publish_source(pending(audit), kw.get("ts_col", "timestamp")), read_ledger(spark, ledger))
    publish_and_ack(todo, tick, lambda rows: send(publish_envelope(rows, **kw)), ledger)


def poll_audit_runs(audit: DataFrame, send: Callable[[DataFrame], None], ledger: RunLedger, tick: int | None = None, **kw) -> bool:
    """One poll as above with a ledger of sorted runs; False if nothing was pending or the tick was acknowledged before."""
    tick = ledger.next_batch() if tick is None else tick
    todo = ledger.absent(publish_source(pending(audit), kw.get("ts_col", "timestamp")))
    return publish_once(todo, tick, lambda rows: send(publish_envelope(rows, **kw)), ledger, skip_empty=True)


def snapshot_lake_consumer(records: DataFrame, lake: SnapshotLake, quarantine: str, checkpoint: str,
                           row_schema: T.StructType = TRANSACTION_ROW, aliases=TRANSACTION_ALIASES, tz: str = "UTC",
                           trigger: dict | None = None, keep: tuple[str, ...] = (), compact_every: int = 16) -> StreamingQuery:
    """:func:`lake_consumer` into a lake of snapshots: a batch is one commit, and every ``compact_every``
    batches small files are rewritten.  A replayed batch adds nothing to the lake and overwrites its own quarantine part."""
    flagged = flag_bad(records, row_schema, keep=keep, aliases=aliases)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = held_batch(batch)
        try:
            write_quarantine(bad_rows(batch, keep), batch_id, quarantine)
            lake.append(add_date_parts(good_rows(batch, keep), "ts_ms", tz), batch_id)
        finally:
            batch.unpersist()
        if batch_id % compact_every == compact_every - 1:
            lake.compact()

    return (flagged.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())


def jdbc_audit_poll(spark: SparkSession, url: str, table: str, properties: dict[str, str], servers: str,
                    ledger: str, tick: int | None = None) -> None:
    """One poll of a database audit table; the pending filter runs in the database."""
    poll_audit_once(read_audit(spark, url, table, properties), topic_sender(servers), ledger, tick)


def row_log_publisher(records: DataFrame, state: str, checkpoint: str,
                      send: Callable[[DataFrame], None], raw: bool = False,
                      trigger: dict | None = None, bucket_width: int = 1 << 20) -> StreamingQuery:
    """Landed row-log events -> table-map lookup (carried across batches) ->
    one message per row (key ``default_key``) -> ``send``."""
    def sink(looked: DataFrame, batch_id: int) -> None:
        rows = explode_rows(looked)
        send(rows.select(F.lit(ROW_LOG_KEY).alias("key"), row_event_json(rows, raw=raw).alias("value"),
                         F.lit(ROW_LOG_TOPIC).alias("topic")))

    return table_map_stream(records, None, state, checkpoint, bucket_width=bucket_width,
                            trigger=trigger, sink=sink)


def row_log_console(records: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Whole-event raw form with processing time, printed in append mode."""
    return write_console(raw_stream_form(records), trigger=trigger)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="changelake.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    lc = sub.add_parser("lake-consumer", help="topic of change envelopes -> date-partitioned lake")
    lc.add_argument("--servers", required=True)
    lc.add_argument("--topic", required=True)
    lc.add_argument("--lake", required=True)
    lc.add_argument("--checkpoint", required=True)
    lc.add_argument("--tz", default="UTC")
    lc.add_argument("--max-offsets-per-trigger", type=int)
    pb = sub.add_parser("publisher", help="audit folder -> topics, acknowledged in a ledger")
    pb.add_argument("--audit", required=True)
    pb.add_argument("--servers", required=True)
    pb.add_argument("--ledger", required=True)
    pb.add_argument("--checkpoint", required=True)
    pb.add_argument("--interval", default="5 seconds")
    rl = sub.add_parser("row-log", help="landed row-log events -> one message per row on a topic")
    rl.add_argument("--events", required=True, help="folder of landed events (parquet or json)")
    rl.add_argument("--format", default="parquet")
    rl.add_argument("--servers", required=True)
    rl.add_argument("--state", required=True)
    rl.add_argument("--checkpoint", required=True)
    rl.add_argument("--max-files-per-trigger", type=int, default=100)
    rl.add_argument("--raw", action="store_true", help="unquoted values, as the listener renders them")
    cp = sub.add_parser("capture", help="two versions of a table -> audit rows, once")
    cp.add_argument("--old", required=True, help="folder of the old version (parquet)")
    cp.add_argument("--new", required=True)
    cp.add_argument("--key", required=True, help="key columns, comma-separated")
    cp.add_argument("--audit", required=True)
    cp.add_argument("--db", required=True)
    cp.add_argument("--table", required=True)
    cp.add_argument("--version", required=True, help="names the capture; one that is complete is not run again")
    cp.add_argument("--cols", help="captured columns, comma-separated (default: all)")
    ap = sub.add_parser("audit-poll", help="one poll of an audit table -> topics, acknowledged in a ledger of runs")
    ap.add_argument("--servers", required=True)
    ap.add_argument("--ledger", required=True)
    ap.add_argument("--audit", help="audit folder")
    ap.add_argument("--url", help="database of the audit table")
    ap.add_argument("--table", help="audit table of the database")
    ap.add_argument("--property", action="append", default=[], help="name=value for the database reader")
    args = p.parse_args(argv)
    if args.job == "audit-poll" and (args.audit is None) == (args.url is None or args.table is None):
        p.error("audit-poll needs --audit, or --url and --table")
    spark = apply_recommended(SparkSession.builder.appName(f"changelake-{args.job}").getOrCreate())
    if args.job == "capture":
        capture_job(spark.read.parquet(args.old), spark.read.parquet(args.new), args.key.split(","), args.audit,
                    cols=args.cols.split(",") if args.cols else None, db_name=args.db, table_name=args.table,
                    version=args.version, own_folder=True)
        return
    if args.job == "audit-poll":
        audit = (read_audit_folder(spark, args.audit) if args.audit else
                 read_audit(spark, args.url, args.table, dict(x.split("=", 1) for x in args.property)))
        poll_audit_runs(audit, topic_sender(args.servers), RunLedger(spark, args.ledger))
        return
    if args.job == "lake-consumer":
        qs = kafka_lake_consumer(spark, args.servers, args.topic, args.lake, args.checkpoint, tz=args.tz,
                                 max_offsets_per_trigger=args.max_offsets_per_trigger)
    elif args.job == "publisher":
        qs = [audit_publisher(spark, args.audit, topic_sender(args.servers), args.ledger, args.checkpoint,
                              trigger={"processingTime": args.interval})]
    else:
        records = read_row_events(spark, args.events, fmt=args.format, stream=True,
                                  max_files_per_trigger=args.max_files_per_trigger)
        qs = [row_log_publisher(records, args.state, args.checkpoint, topic_sender(args.servers), raw=args.raw)]
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in qs:
            if q.isActive:
                q.stop()


if __name__ == "__main__":
    main()
