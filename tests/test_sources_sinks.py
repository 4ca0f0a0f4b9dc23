"""Lake sink/source, table registration, synthetic rows."""

import datetime as dt

from pyspark.sql import functions as F

from changelake.schemas import AUDIT
from changelake.session import scratch_path
from changelake.sinks.lake import ensure_table, register_lake, write_lake
from changelake.sources.files import read_lake
from changelake.sources.synth import PAYMENT_METHODS, synth_transactions


def dated(spark):
    return spark.range(0, 300).select(
        "id", F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 30 + 1).cast("int").alias("day"))


def test_write_and_read_lake_with_range(spark):
    path = scratch_path(spark, "t-lake")
    write_lake(dated(spark), path)
    df = read_lake(spark, path, start=dt.date(2024, 1, 10), end="2024-01-11")
    assert df.count() == 20
    assert "PartitionFilters" in df._jdf.queryExecution().executedPlan().toString()


def test_register_batch_lake_and_query(spark):
    path = scratch_path(spark, "t-reg")
    write_lake(dated(spark), path)
    name = "lake_" + path.rsplit("-", 1)[1]
    register_lake(spark, name, path, streamed=False)
    assert spark.sql(f"select count(*) c from {name} where day = 3").first().c == 10
    spark.sql(f"drop table {name}")


def test_ensure_table_idempotent(spark):
    path = scratch_path(spark, "t-ensure")
    name = "audit_" + path.rsplit("-", 1)[1]
    ensure_table(spark, name, AUDIT, path=path)
    ensure_table(spark, name, AUDIT, path=path)
    assert spark.table(name).columns == AUDIT.fieldNames()
    spark.sql(f"drop table {name}")


def test_synth_is_stable_over_partitions(spark):
    ids = spark.range(0, 500)
    a = sorted(tuple(r) for r in synth_transactions(ids.repartition(1)).collect())
    b = sorted(tuple(r) for r in synth_transactions(ids.repartition(9)).collect())
    assert a == b
    amounts = [r.amount for r in synth_transactions(ids).collect()]
    assert min(amounts) >= 10 and max(amounts) <= 1000
    pm = {r.payment_method for r in synth_transactions(ids).collect()}
    assert pm <= set(PAYMENT_METHODS) and len(pm) == 3


def test_register_streamed_lake_uses_its_file_log(spark):
    from changelake.streaming.lake_stream import run_to_end, write_lake_stream

    root = scratch_path(spark, "t-reg-stream")
    dated(spark).write.parquet(f"{root}/in")
    src = spark.readStream.schema(dated(spark).schema).parquet(f"{root}/in")
    run_to_end(write_lake_stream(src, f"{root}/lake", f"{root}/cp", trigger={"availableNow": True}))
    name = "slake_" + root.rsplit("-", 1)[1]
    register_lake(spark, name, f"{root}/lake", streamed=True)
    assert spark.sql(f"select count(*) c from {name}").first().c == 300
    assert spark.sql(f"select count(*) c from {name} where day = 3").first().c == 10
    spark.sql(f"drop table {name}")


def test_console_sink_runs(spark, capsys):
    from changelake.sinks.lake import write_console
    from changelake.streaming.lake_stream import run_to_end

    root = scratch_path(spark, "t-console")
    dated(spark).limit(3).write.parquet(root)
    src = spark.readStream.schema(dated(spark).schema).parquet(root)
    q = write_console(src, trigger={"availableNow": True})
    run_to_end(q)
    assert q.lastProgress["numInputRows"] == 3


def test_max_records_per_file(spark):
    import os

    path = scratch_path(spark, "t-maxrec")
    df = spark.range(0, 100).select("id", F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"))
    write_lake(df, path, max_records_per_file=10)
    files = [f for _, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")]
    assert len(files) >= 10
    assert read_lake(spark, path).count() == 100


def test_rebalance_splits_a_hot_day(spark):
    import os

    path = scratch_path(spark, "t-hotday")
    # day 1 holds a third of the rows
    df = spark.range(0, 30000).select(
        "id", (F.col("id") * 7919 % 1000003).cast("string").alias("pad"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 29 + 2).cast("int")).alias("day"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        write_lake(df, path, balance="rebalance")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = os.path.join(path.replace("file:", ""), "year=2024", "month=1", "day=1")
    assert len([f for f in os.listdir(hot) if f.endswith(".parquet")]) > 1  # written by several tasks
    assert read_lake(spark, path).count() == 30000


def test_synth_amount_type(spark):
    df = synth_transactions(spark.range(0, 50), amount_type="decimal(10,2)")
    assert df.schema["amount"].dataType.simpleString() == "decimal(10,2)"
