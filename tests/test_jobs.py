"""The composed pipelines, run on file sources (no broker here)."""

import json

from pyspark.sql import functions as F

from changelake.plans import fixtures as fx
from changelake.plans.jobs import (
    audit_publisher,
    capture_job,
    lake_consumer,
    poll_audit_once,
    row_log_publisher,
)
from changelake.session import scratch_path
from changelake.sinks.ledger import read_ledger
from changelake.streaming.lake_stream import run_to_end

NOW = {"availableNow": True}


def test_lake_consumer_on_transaction_envelopes(spark):
    root = scratch_path(spark, "j-lake")
    msgs = spark.createDataFrame(
        [('{"payload":{"before":null,"after":{"transaction_id":"t1","amount":"12.50","affiliateId":"a"},'
          '"op":"c","ts_ms":1717200000123}}',),
         ('{"payload":{"before":{"transaction_id":"t1"},"after":null,"op":"d","ts_ms":1717286400000}}',),
         ("not json",)],
        "value string",
    )
    msgs.write.parquet(f"{root}/in")
    src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
    run_to_end(*lake_consumer(src, f"{root}/lake", f"{root}/cp", trigger=NOW))
    lake = spark.read.parquet(f"{root}/lake")
    got = sorted((r.op, r.year, r.month, r.day) for r in lake.collect())
    assert got == [("c", 2024, 6, 1), ("d", 2024, 6, 2)]
    assert lake.filter("op = 'c'").first().after.affiliateid == "a"
    assert spark.read.parquet(f"{root}/lake_quarantine").first().bad_reason == "corrupt"


def test_capture_then_publisher_round_trip(spark, sf_dir):
    root = scratch_path(spark, "j-pub")
    old, new = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    capture_job(old, new, "o_orderkey", f"{root}/audit", db_name="tpch", table_name="orders",
                captured_at=fx.captured_at(), version="v2")
    n_audit = spark.read.parquet(f"{root}/audit").count()

    def send(df):
        df.write.mode("append").parquet(f"{root}/topic")

    run_to_end(audit_publisher(spark, f"{root}/audit", send, f"{root}/ledger", f"{root}/cp", trigger=NOW))
    sent = spark.read.parquet(f"{root}/topic")
    assert sent.count() == n_audit
    assert {r.topic for r in sent.select("topic").distinct().collect()} == {"kfk_stream_orders"}
    # a later poll of the same audit table finds nothing left to publish
    before = spark.read.parquet(f"{root}/topic").count()
    poll_audit_once(spark.read.parquet(f"{root}/audit"), send, f"{root}/ledger", tick=99)
    assert spark.read.parquet(f"{root}/topic").count() == before
    assert read_ledger(spark, f"{root}/ledger").count() == n_audit


def test_row_log_publisher_messages(spark, sf_dir):
    root = scratch_path(spark, "j-rowlog")
    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    records.filter(F.col("position") < 500).coalesce(1).write.parquet(f"{root}/in")
    records.filter(F.col("position") >= 500).coalesce(1).write.mode("append").parquet(f"{root}/in")
    from changelake.sources.files import read_row_events

    src = read_row_events(spark, f"{root}/in", stream=True, max_files_per_trigger=1)

    def send(df):
        df.write.mode("append").parquet(f"{root}/topic")

    run_to_end(row_log_publisher(src, f"{root}/state", f"{root}/cp", send, trigger=NOW))
    out = spark.read.parquet(f"{root}/topic")
    n_rows = fx.table(spark, sf_dir, "events").filter("event_type <> 'error'").count()
    assert out.count() == n_rows
    assert {r.key for r in out.select("key").distinct().collect()} == {"default_key"}
    msg = json.loads(out.first().value)
    assert msg["event"] == "INSERT" and set(msg) == {"event", "database", "table", "values"}
