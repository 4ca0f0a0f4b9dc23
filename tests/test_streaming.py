"""Stream = batch, restart on the same checkpoint, carried table map, dedup."""

from pyspark.sql import functions as F

from changelake.operators.envelope import add_date_parts, split_bad
from changelake.plans import fixtures as fx
from changelake.session import scratch_path
from changelake.sources.files import read_row_events
from changelake.streaming.dedup import drop_redelivered, drop_redelivered_stream
from changelake.plans.jobs import lake_consumer
from changelake.streaming.lake_stream import run_to_end, write_lake_stream
from changelake.streaming.publish import publish_stream
from changelake.streaming.table_map import table_map_stream
from changelake.operators.rowevents import lookup_table_map
from changelake.sinks.ledger import read_ledger


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_envelope_stream_equals_batch_and_restart_adds_nothing(spark, sf_dir):
    root = scratch_path(spark, "t-env-stream")
    msgs = fx.event_messages(fx.table(spark, sf_dir, "events"), truncate_type="error")
    msgs.write.parquet(f"{root}/in")

    def run():
        src = spark.readStream.schema(msgs.schema).parquet(f"{root}/in")
        run_to_end(*lake_consumer(src, f"{root}/lake", f"{root}/cp", quarantine=f"{root}/bad", row_schema=fx.EVENT_ENVELOPE_ROW,
                                  aliases=None, trigger={"availableNow": True}, keep=("key",)))

    run()
    good, bad = split_bad(spark.read.parquet(f"{root}/in"), fx.EVENT_ENVELOPE_ROW, keep=("key",))
    cols = ["key", "op", "ts_ms", "year", "month", "day"]
    lake = spark.read.parquet(f"{root}/lake")
    assert rows(lake, cols) == rows(add_date_parts(good), cols)
    assert rows(spark.read.parquet(f"{root}/bad"), ["key", "bad_reason"]) == rows(bad, ["key", "bad_reason"])
    # restart on the same checkpoint with no new input: nothing is repeated
    run()
    assert spark.read.parquet(f"{root}/lake").count() == lake.count()
    # new input after restart is appended exactly once
    msgs.limit(5).write.mode("append").parquet(f"{root}/in")
    run()
    total = spark.read.parquet(f"{root}/lake").count() + spark.read.parquet(f"{root}/bad").count()
    assert total == msgs.count() + 5


def test_lake_batch_replay_overwrites_its_own_folders(spark, sf_dir):
    from changelake.sinks.lake import register_lake, write_batch

    root = scratch_path(spark, "t-replay")
    good, bad = split_bad(fx.event_messages(fx.table(spark, sf_dir, "events"), truncate_type="error"),
                          fx.EVENT_ENVELOPE_ROW, keep=("key",))
    dated = add_date_parts(good)
    for batch_id in (0, 1, 1, 0):
        write_batch(dated, bad, batch_id, f"{root}/lake", f"{root}/bad")
    assert spark.read.parquet(f"{root}/lake").count() == 2 * dated.count()
    assert spark.read.parquet(f"{root}/bad").count() == 2 * bad.count()
    register_lake(spark, "t_replayed_lake", f"{root}/lake")
    assert spark.table("t_replayed_lake").where("batch_id = 1").count() == dated.count()


def test_stream_lake_prunes_partitions(spark, sf_dir):
    root = scratch_path(spark, "t-prune")
    ev = fx.table(spark, sf_dir, "events").withColumns(
        {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})
    ev.write.parquet(f"{root}/in")
    src = spark.readStream.schema(ev.schema).parquet(f"{root}/in")
    run_to_end(write_lake_stream(src, f"{root}/lake", f"{root}/cp", trigger={"availableNow": True}))
    from changelake.sources.files import read_lake

    df = read_lake(spark, f"{root}/lake", start="2024-01-05", end="2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert df.count() == ev.filter((F.col("day") >= 5) & (F.col("day") <= 6)).count()


def test_table_map_stream_equals_batch(spark, sf_dir):
    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "t-tmap")
    for lo in range(0, 1000, 250):  # arrive in position order, 4 batches
        records.filter((F.col("position") >= lo) & (F.col("position") < lo + 250)).coalesce(1) \
            .write.mode("append").parquet(f"{root}/in")
    src = read_row_events(spark, f"{root}/in", stream=True, max_files_per_trigger=1)
    run_to_end(table_map_stream(src, f"{root}/out", f"{root}/state", f"{root}/cp", bucket_width=100,
                                trigger={"availableNow": True}))
    maps, evs = fx.event_maps_and_rows(fx.table(spark, sf_dir, "events"))
    batch = lookup_table_map(evs, maps)
    cols = ["position", "table_id", "database", "table"]
    out = spark.read.parquet(f"{root}/out")
    assert out.select("batch_id").distinct().count() == 4
    assert rows(out, cols) == rows(batch, cols)


def test_dedup_keeps_late_unique_rows_across_batches(spark):
    """Unique rows two hours behind, one file a batch: none is lost, copies in later batches are."""
    root = scratch_path(spark, "t-late")
    lots = [[("a", "2024-01-01 12:00:00")], [("b", "2024-01-01 10:00:00")], [("a", "2024-01-01 12:00:00"), ("c", "2024-01-01 09:00:00")]]
    for lot in lots:
        spark.createDataFrame(lot, "audit_log_id string, ts string").coalesce(1).write.mode("append").parquet(f"{root}/in")
        src = spark.readStream.schema("audit_log_id string, ts string").parquet(f"{root}/in")
        landed = src.withColumn("landed", F.col("_metadata.file_modification_time"))
        run_to_end(drop_redelivered_stream(landed, "landed").writeStream.format("parquet")
                   .option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start())
    assert sorted(r.audit_log_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b", "c"]


def test_dedup_stream_equals_batch(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("audit_log_id"), "ts", "event_type")
    dup = ev.unionByName(ev.filter(F.col("event_type") == "click"))
    root = scratch_path(spark, "t-dedup")
    dup.write.parquet(f"{root}/in")
    src = spark.readStream.schema(dup.schema).parquet(f"{root}/in")
    q = (drop_redelivered_stream(src).writeStream.format("parquet")
         .option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
         .trigger(availableNow=True).start())
    run_to_end(q)
    assert rows(spark.read.parquet(f"{root}/out"), ["audit_log_id"]) == rows(drop_redelivered(dup), ["audit_log_id"])
    assert spark.read.parquet(f"{root}/out").count() == ev.count()


def test_publish_stream_acknowledges_each_row_once(spark, sf_dir):
    audit = fx.order_audit(fx.table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "t-pub")
    audit.write.parquet(f"{root}/in")
    src = spark.readStream.schema(audit.schema).option("maxFilesPerTrigger", "2").parquet(f"{root}/in")

    def send(batch):
        batch.write.mode("append").parquet(f"{root}/topic")

    run_to_end(publish_stream(src, send, f"{root}/ledger", f"{root}/cp", trigger={"availableNow": True}))
    sent = spark.read.parquet(f"{root}/topic")
    assert sent.count() == audit.count()
    assert read_ledger(spark, f"{root}/ledger").distinct().count() == audit.count()
    assert set(sent.columns) >= {"key", "value", "topic"}


def test_day_spread_bounds_files_per_day(spark, sf_dir):
    import os

    root = scratch_path(spark, "t-spread")
    ev = fx.table(spark, sf_dir, "events").withColumns(
        {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})
    ev.repartition(6).write.parquet(f"{root}/in")
    src = spark.readStream.schema(ev.schema).parquet(f"{root}/in")
    run_to_end(write_lake_stream(src, f"{root}/lake", f"{root}/cp", trigger={"availableNow": True}, day_spread=2))
    lake_dir = f"{root}/lake".replace("file:", "")
    for dirpath, _, files in os.walk(lake_dir):
        if "day=" in dirpath:
            assert len([f for f in files if f.endswith(".parquet")]) <= 2
    assert spark.read.parquet(f"{root}/lake").count() == ev.count()


def test_table_map_replay_and_restart(spark, sf_dir):
    from changelake.streaming.table_map import table_map_batch

    records = fx.event_landed_records(fx.table(spark, sf_dir, "events"))
    root = scratch_path(spark, "t-tmap-restart")
    first = records.filter(F.col("position") < 400)
    # replaying batch 0 (as after a failure before commit) rewrites, never adds
    table_map_batch(first, 0, f"{root}/replay_out", f"{root}/replay_state", bucket_width=64)
    table_map_batch(first, 0, f"{root}/replay_out", f"{root}/replay_state", bucket_width=64)
    n0 = first.filter(F.col("event_type") != "TABLE_MAP").count()
    assert spark.read.parquet(f"{root}/replay_out").count() == n0

    # a stream stopped after the first files and restarted on the same
    # checkpoint carries the map across the restart
    for lo in (0, 300):
        records.filter((F.col("position") >= lo) & (F.col("position") < lo + 300)).coalesce(1) \
            .write.mode("append").parquet(f"{root}/in")
    def start():
        src = read_row_events(spark, f"{root}/in", stream=True, max_files_per_trigger=1)
        return table_map_stream(src, f"{root}/out", f"{root}/state", f"{root}/cp", bucket_width=64,
                                trigger={"availableNow": True})
    run_to_end(start())
    for lo in (600, 900):
        records.filter((F.col("position") >= lo) & (F.col("position") < lo + 300)).coalesce(1) \
            .write.mode("append").parquet(f"{root}/in")
    run_to_end(start())
    maps, evs = fx.event_maps_and_rows(fx.table(spark, sf_dir, "events"))
    cols = ["position", "table_id", "database", "table"]
    out = spark.read.parquet(f"{root}/out")
    assert out.select("batch_id").distinct().count() == 4
    assert rows(out, cols) == rows(lookup_table_map(evs, maps), cols)


def test_one_publisher_serves_many_tables(spark, sf_dir):
    from changelake.plans.jobs import audit_publisher, capture_job

    root = scratch_path(spark, "t-multi")
    old, new = fx.order_versions(fx.table(spark, sf_dir, "orders"))
    capture_job(old, new, "o_orderkey", f"{root}/audit", db_name="tpch", table_name="orders", version="v1")
    cust = fx.table(spark, sf_dir, "customer")
    capture_job(cust.filter("c_nationkey <> 1"), cust.filter("c_nationkey <> 2"), "c_custkey", f"{root}/audit",
                db_name="tpch", table_name="customer", version="v1")

    def send(df):
        df.write.mode("append").parquet(f"{root}/topic")

    run_to_end(audit_publisher(spark, f"{root}/audit", send, f"{root}/ledger", f"{root}/cp",
                               trigger={"availableNow": True}))
    per_topic = {r.topic: r["count"] for r in spark.read.parquet(f"{root}/topic").groupBy("topic").count().collect()}
    audit = spark.read.parquet(f"{root}/audit")
    expect = {f"kfk_stream_{r.table_name}": r["count"] for r in audit.groupBy("table_name").count().collect()}
    assert per_topic == expect and len(expect) == 2


def test_table_map_state_is_pruned_and_late_maps_stop_the_stream(spark):
    import pytest

    from changelake.sinks.lake import path_exists
    from changelake.streaming.table_map import table_map_batch

    root = scratch_path(spark, "t-tmap-late")
    schema = "position long, event_type string, table_id long, database string, table string"

    def batch(*records):
        return spark.createDataFrame([(p, k, 1, d, d) for p, k, d in records], schema)

    parts = [batch((1, "TABLE_MAP", "a"), (2, "INSERT", None)), batch((3, "INSERT", None)), batch((5, "TABLE_MAP", "b"), (6, "INSERT", None))]
    for i, part in enumerate(parts):
        table_map_batch(part, i, f"{root}/out", f"{root}/state")
    out = spark.read.parquet(f"{root}/out")
    assert rows(out, ["position", "database"]) == [(2, "a"), (3, "a"), (6, "b")]
    assert [path_exists(spark, f"{root}/state/batch_id={i}") for i in range(3)] == [False, True, True]
    with pytest.raises(ValueError, match="position 4"):
        table_map_batch(batch((4, "TABLE_MAP", "c"), (7, "INSERT", None)), 3, f"{root}/out", f"{root}/state")


def test_a_held_batch_is_cut_by_size_and_keeps_only_bad_messages(spark):
    from changelake.streaming.lake_stream import held_batch

    reason = F.when(F.col("id") % 10 == 0, F.lit("corrupt"))
    one = spark.range(20000, numPartitions=1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("message"), reason.alias("bad_reason"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "128KB")
    try:
        held = held_batch(one)
        assert held.count() == 20000 and held.rdd.getNumPartitions() > 3
        assert held.where("(message is null) != (bad_reason is null)").isEmpty()
        held.unpersist()
    finally:
        spark.conf.set(size, before)
