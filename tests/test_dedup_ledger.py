"""Redelivered messages against a ledger of runs; captures in folders of their own; the jobs of the command line."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changelake.plans.jobs import capture_job, main, read_audit_folder
from changelake.session import scratch_path
from changelake.sinks.lake import CAPTURE_COLUMN, append_audit, append_capture, path_exists, write_batch
from changelake.sinks.runs import RunLedger
from changelake.streaming.dedup import drop_redelivered_ledger

SCHEMA = "audit_log_id string, v long"


def land(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")


def to_folders(root):
    return lambda rows, batch_id: write_batch(rows, rows.limit(0), batch_id, f"{root}/out", f"{root}/bad", by=())


def run(spark, root, sink, per_batch=1):
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", str(per_batch)).parquet(f"{root}/in")
    q = drop_redelivered_ledger(src, sink, RunLedger(spark, f"{root}/ledger", fanout=2), f"{root}/cp", trigger={"processingTime": "0 seconds"})
    try:
        q.processAllAvailable()
        return len([p for p in q.recentProgress if p["numInputRows"]])
    finally:
        q.stop()


def test_copies_within_and_between_batches_and_restarts(spark):
    root = scratch_path(spark, "t-dedup")
    land(spark, root, [("a", 1), ("a", 1), ("b", 1), (None, 7), (None, 7)])
    land(spark, root, [("b", 1), ("c", 1)])
    land(spark, root, [])
    assert run(spark, root, to_folders(root)) >= 2  # a file a batch
    land(spark, root, [("a", 1), ("d", 1), (None, 7)])
    run(spark, root, to_folders(root))
    got = sorted((r.audit_log_id or "", r.v) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("", 7), ("", 7), ("", 7), ("a", 1), ("b", 1), ("c", 1), ("d", 1)]
    assert sorted(r[0] for r in RunLedger(spark, f"{root}/ledger").ids().collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("after_write", [False, True])
def test_a_batch_lost_before_the_ledger_is_sent_again_once(spark, after_write):
    root = scratch_path(spark, "t-dedup-lost")
    land(spark, root, [("a", 1), ("b", 1), ("a", 1)])

    def lost(rows, batch_id):
        if after_write:
            to_folders(root)(rows, batch_id)
        raise OSError("lost")

    with pytest.raises(StreamingQueryException):
        run(spark, root, lost)
    assert RunLedger(spark, f"{root}/ledger").runs() == []
    run(spark, root, to_folders(root))
    assert sorted(r.audit_log_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b"]


def test_a_hot_id_and_a_one_third_hot_batch(spark):
    root = scratch_path(spark, "t-dedup-hot")
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("audit_log_id"),
                                    F.lit(1).cast("long").alias("v"))
    for _ in range(2):
        rows.write.mode("append").parquet(f"{root}/in")
    run(spark, root, to_folders(root))
    assert spark.read.parquet(f"{root}/out").count() == 2001


def versions(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, x string")
    return old, new


def test_a_capture_is_written_once(spark):
    at = f"{scratch_path(spark, 't-capture')}/audit"
    old, new = versions(spark)
    for _ in range(2):
        capture_job(old, new, "k", at, version="v 1/2", own_folder=True)
    capture_job(new, old, "k", at, version="v2", own_folder=True)
    got = sorted((r.record_id, r.operation) for r in read_audit_folder(spark, at).collect())
    assert got == sorted([("2", "U"), ("3", "D"), ("4", "I"), ("2", "U"), ("3", "I"), ("4", "D")])
    names = {r[0] for r in spark.read.parquet(at).select(CAPTURE_COLUMN).distinct().collect()}
    assert names == {"db.table.v 1/2", "db.table.v2"}
    with pytest.raises(ValueError, match="version"):
        capture_job(old, new, "k", at, own_folder=True, captured_at=F.current_timestamp())


def test_capture_folders_and_loose_rows_do_not_mix(spark):
    at = f"{scratch_path(spark, 't-capture-mixed')}/audit"
    rows = spark.createDataFrame([("x",)], "audit_log_id string")
    append_audit(rows, at)
    with pytest.raises(ValueError, match="append_audit"):
        append_capture(rows, at, "v1")


def test_command_line_capture_and_poll_arguments(spark):
    root = scratch_path(spark, "t-cli")
    old, new = versions(spark)
    old.write.parquet(f"{root}/old")
    new.write.parquet(f"{root}/new")
    args = ["capture", "--old", f"{root}/old", "--new", f"{root}/new", "--key", "k", "--audit", f"{root}/audit",
            "--db", "shop", "--table", "items", "--version", "v1", "--cols", "k,x"]
    for _ in range(2):
        main(args)
    assert path_exists(spark, f"{root}/audit/{CAPTURE_COLUMN}=shop.items.v1/_SUCCESS")
    got = read_audit_folder(spark, f"{root}/audit")
    assert sorted((r.table_name, r.record_id, r.operation) for r in got.collect()) == [
        ("items", "2", "U"), ("items", "3", "D"), ("items", "4", "I")]
    with pytest.raises(SystemExit):
        main(["audit-poll", "--servers", "s", "--ledger", "l"])
