"""Audit capture, publish envelope, ledger, key checks."""

import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changelake.operators.audit import (
    capture_changes,
    check_key,
    pending,
    publish_envelope,
    publish_records,
    unpublished,
)
from changelake.plans import fixtures as fx
from changelake.session import scratch_path
from changelake.sinks.ledger import publish_and_ack, read_ledger

SCHEMA = "id long, name string, amount decimal(18,2)"


def versions(spark):
    D = Decimal
    old = spark.createDataFrame([(1, "a", D(1)), (2, "b", D(2)), (3, "c", D(3)), (5, None, D(5))], SCHEMA)
    new = spark.createDataFrame([(1, "a", D(1)), (2, "B", D(2)), (4, "d", D(4)), (5, None, D(6))], SCHEMA)
    return old, new


def test_capture_ops_and_images(spark):
    old, new = versions(spark)
    out = {r.record_id: r for r in capture_changes(old, new, "id", table_name="t", version="v1").collect()}
    assert {k: v.operation for k, v in out.items()} == {"2": "U", "3": "D", "4": "I", "5": "U"}
    assert out["4"].old_data is None and json.loads(out["4"].new_data) == {"id": 4, "name": "d", "amount": 4}
    assert out["3"].new_data is None and json.loads(out["3"].old_data)["name"] == "c"
    assert out["5"].new_data == '{"id":5,"name":null,"amount":6.00}'
    assert all(r.is_in_kafka is False for r in out.values())


def test_capture_subset_still_sees_changes_outside_it(spark):
    old, new = versions(spark)
    out = {r.record_id: r for r in capture_changes(old, new, "id", cols=["name"], version="v1").collect()}
    assert out["5"].operation == "U"  # amount changed, image shows only name
    assert out["5"].old_data == out["5"].new_data == '{"name":null}'


def test_capture_replayed_on_old_gives_new(spark):
    old, new = versions(spark)
    audit = capture_changes(old, new, "id", version="v1")
    state = {r.id: (r.name, r.amount) for r in old.collect()}
    for r in audit.collect():
        if r.operation == "D":
            del state[int(r.record_id)]
        else:
            img = json.loads(r.new_data)
            state[img["id"]] = (img["name"], img["amount"])
    expect = {r.id: (r.name, float(r.amount)) for r in new.collect()}
    assert {k: (v[0], float(v[1])) for k, v in state.items()} == expect


def test_audit_ids_are_deterministic(spark):
    old, new = versions(spark)
    a = sorted(r.audit_log_id for r in capture_changes(old, new, "id", version="v1").collect())
    b = sorted(r.audit_log_id for r in capture_changes(old.repartition(3), new, "id", version="v1").collect())
    assert a == b and len(set(a)) == 4


def test_composite_key(spark):
    old = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, v string")
    new = spark.createDataFrame([(1, 1, "x"), (1, 2, "z")], "a int, b int, v string")
    out = capture_changes(old, new, ["a", "b"], version="v1").collect()
    assert [(r.record_id, r.operation) for r in out] == [('["1","2"]', "U")]
    apart = spark.createDataFrame([("x|y", "z", 1), ("x", "y|z", 1)], "a string, b string, v int")
    ids = [r.audit_log_id for r in capture_changes(apart.limit(0), apart, ["a", "b"], version="v1").collect()]
    assert len(set(ids)) == 2


def test_capture_needs_an_identity(spark):
    old, new = versions(spark)
    with pytest.raises(ValueError):
        capture_changes(old, new, "id")


def test_added_and_dropped_columns_are_updates(spark):
    a = spark.createDataFrame([(1, "x", 5)], "id int, v string, gone int")
    b = spark.createDataFrame([(1, "x", 7)], "id int, v string, added int")
    row = capture_changes(a, b, "id", version="v1").first()
    assert (row.operation, json.loads(row.old_data), json.loads(row.new_data)) == (
        "U", {"id": 1, "v": "x", "gone": 5}, {"id": 1, "v": "x", "added": 7})


def test_ledger_refuses_a_used_batch_id_and_owns_the_next(spark):
    from changelake.session import scratch_path
    from changelake.sinks.ledger import next_batch_id, publish_and_ack, read_ledger
    ledger = scratch_path(spark, "t-ticks") + "/ledger"
    one, two = (spark.createDataFrame([(x,)], "audit_log_id string") for x in "ab")
    assert next_batch_id(spark, ledger) == 0
    publish_and_ack(one, 0, lambda df: df.count(), ledger)
    with pytest.raises(ValueError):
        publish_and_ack(two, 0, lambda df: df.count(), ledger)
    assert next_batch_id(spark, ledger) == 1
    publish_and_ack(two, 1, lambda df: df.count(), ledger)
    assert sorted(r.audit_log_id for r in read_ledger(spark, ledger).collect()) == ["a", "b"]


def test_publish_envelope_fields_and_delete(spark):
    old, new = versions(spark)
    audit = capture_changes(old, new, "id", db_name="fin", table_name="tx",
                            captured_at=F.timestamp_millis(F.lit(1717200001999)))
    env = {r.key: r for r in publish_envelope(audit).collect()}
    msg = json.loads(env["3"].value)
    assert list(msg) == ["db_type", "db_name", "table_name", "record_id", "new_data", "hash_id", "hash_pk",
                         "hash_record", "operation", "timestamp_epoch", "data"]
    assert msg["operation"] == "D" and msg["new_data"] is None and msg["hash_record"] is None
    assert msg["timestamp_epoch"] == 1717200001 and msg["data"] == "2024-06-01"
    assert msg["hash_pk"] == hashlib.sha256(b"POSTGRESQLfintx31717200001").hexdigest()
    assert env["3"].topic == "kfk_stream_tx"
    ins = json.loads(env["4"].value)
    assert ins["hash_record"] == hashlib.sha256(ins["new_data"].encode()).hexdigest()


def test_publish_records_two_updates_in_one_second(spark):
    rows = [("a1", "db", "t", "7", "U", None, '{"v":1}'), ("a2", "db", "t", "7", "U", None, '{"v":2}')]
    df = spark.createDataFrame(rows, "audit_log_id string, db_name string, table_name string, record_id string, "
                                     "operation string, old_data string, new_data string")
    df = df.withColumn("timestamp", F.when(F.col("audit_log_id") == "a1", F.timestamp_millis(F.lit(1000100)))
                       .otherwise(F.timestamp_millis(F.lit(1000900))))
    r = publish_records(df).collect()
    assert r[0].hash_pk == r[1].hash_pk
    assert r[0].hash_record != r[1].hash_record


def test_pending_excludes_null_flag(spark):
    df = spark.createDataFrame([(1, False), (2, None), (3, True)], "id int, is_in_kafka boolean")
    assert [r.id for r in pending(df).collect()] == [1]


def test_ledger_ack_and_replay(spark):
    old, new = versions(spark)
    audit = capture_changes(old, new, "id", version="v1")
    ledger = scratch_path(spark, "test-ledger")
    sent = []

    def send(b):
        sent.append(b.count())

    first = audit.filter(F.col("operation") == "U")
    publish_and_ack(first, 0, send, ledger)
    publish_and_ack(first, 0, send, ledger)  # replay of batch 0 overwrites its own part
    assert read_ledger(spark, ledger).count() == 2
    left = {r.record_id for r in unpublished(audit, read_ledger(spark, ledger)).collect()}
    assert left == {"3", "4"}


def test_failed_send_leaves_rows_pending(spark):
    old, new = versions(spark)
    audit = capture_changes(old, new, "id", version="v1")
    ledger = scratch_path(spark, "test-ledger-fail")

    def boom(b):
        raise RuntimeError("broker down")

    try:
        publish_and_ack(audit, 0, boom, ledger)
    except RuntimeError:
        pass
    assert unpublished(audit, read_ledger(spark, ledger)).count() == 4


def test_check_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    got = {(r.k, r.n, r.violation) for r in check_key(df, "k").collect()}
    assert got == {(1, 2, "duplicate_key"), (None, 1, "null_key")}


def test_capture_refuses_duplicate_keys(spark):

    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c")], "id long, v string")
    with pytest.raises(Exception, match="old: key .* is not a primary key"):
        capture_changes(old, new, "id", version="v1").collect()
    nulls = spark.createDataFrame([(None, "a")], "id long, v string")
    with pytest.raises(Exception, match="new: key .*null or repeated"):
        capture_changes(new, nulls, "id", version="v1").collect()
    same = capture_changes(new, new, "id", version="v1")
    plan = same._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the check shares the exchange of the join
    assert same.collect() == []


def test_check_key_aggregates_map_side(spark):
    # one key holds a third of the rows: the count is partial per task before the shuffle
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    out = check_key(df, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert out.filter("k = 0").first().n == 10000


def test_drop_redelivered_collapses_hot_id(spark):
    from changelake.streaming.dedup import drop_redelivered

    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("audit_log_id"))
    plan = drop_redelivered(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2  # partial + final
    assert drop_redelivered(df).count() == 20001


def test_publish_detects_ntz_change_time(spark):
    rows = [("a1", "db", "t", "7", "I", None, '{"v":1}')]
    df = spark.createDataFrame(rows, "audit_log_id string, db_name string, table_name string, record_id string, "
                                     "operation string, old_data string, new_data string")
    ntz = df.withColumn("timestamp", F.lit("2024-06-01 00:00:01").cast("timestamp_ntz"))
    ltz = df.withColumn("timestamp", F.timestamp_millis(F.lit(1717200001000)))
    a, b = publish_records(ntz).first(), publish_records(ltz).first()
    assert a.timestamp_epoch == b.timestamp_epoch == 1717200001
    assert a.data == b.data == "2024-06-01"


def test_capture_run_again_appends_nothing(spark, sf_dir):
    from changelake.plans.jobs import capture_job

    root = scratch_path(spark, "t-rerun")
    old, new = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    for _ in range(2):
        capture_job(old, new, "o_orderkey", f"{root}/audit", db_name="tpch", table_name="orders", version="v2")
    audit = spark.read.parquet(f"{root}/audit")
    assert audit.count() == audit.select("audit_log_id").distinct().count() > 0
