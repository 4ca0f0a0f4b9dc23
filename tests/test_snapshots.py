"""The lake of snapshots: appends, zone maps, compaction, crashes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from changelake.sinks.manifest import ManifestConflict
from changelake.sinks.snapshots import DATE, SnapshotLake


def batch(spark, k, n=400, days=20):
    """Rows of 20 days; a third of them on one day."""
    day = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise((F.col("id") % days).cast("int"))
    ts = F.to_timestamp(F.lit("2024-03-01 00:00:00")) + F.make_interval(days=day, mins=(F.col("id") % 1440).cast("int"))
    rows = spark.range(k * n, (k + 1) * n).select("id", ts.alias("ts"), F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("v"))
    return rows.select("*", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))


@pytest.fixture()
def lake(spark, tmp_path):
    return SnapshotLake(spark, str(tmp_path / "lake"), batch(spark, 0).schema, zones=("ts", "v"), target_bytes=1 << 20)


def content(df):
    return sorted(map(tuple, df.collect()))


def whole(spark, n):
    out = batch(spark, 0)
    for k in range(1, n):
        out = out.unionByName(batch(spark, k))
    return content(out)


def test_append_replay_and_pinned_readers(spark, lake):
    assert lake.snapshot() == 0 and content(lake.read()) == []
    for k in range(3):
        assert lake.append(batch(spark, k), k)
    pinned = lake.snapshot()
    assert lake.append(batch(spark, 1), 1) is False
    lake.append(batch(spark, 3), 3)
    assert content(lake.read(snapshot=pinned)) == whole(spark, 3) and content(lake.read()) == whole(spark, 4)
    assert lake.compact() > 1
    assert content(lake.read(snapshot=pinned)) == whole(spark, 3) and content(lake.read()) == whole(spark, 4)


def test_compaction_bounds_the_files_and_a_crash_changes_nothing(spark, lake):
    for k in range(5):
        lake.append(batch(spark, k), k)
    before, many = lake.snapshot(), lake.files().count()

    def crash():
        raise OSError("lost")

    with pytest.raises(OSError):
        lake.compact(crash)
    assert lake.snapshot() == before and content(lake.read()) == whole(spark, 5)
    assert lake.vacuum() >= 2
    assert lake.compact() == many and lake.files().count() == 1 and lake.compact() == 0
    assert content(lake.read()) == whole(spark, 5)


def test_append_during_compaction_stays(spark, lake):
    for k in range(3):
        lake.append(batch(spark, k), k)
    assert lake.compact(lambda: lake.append(batch(spark, 3), 3)) > 1
    assert content(lake.read()) == whole(spark, 4)


def test_vacuum_keeps_what_kept_snapshots_name(spark, tmp_path):
    lake = SnapshotLake(spark, str(tmp_path / "lake"), batch(spark, 0).schema, zones=("ts",), keep=1)
    for k in range(3):
        lake.append(batch(spark, k), k)
    lake.compact()
    assert lake.vacuum() > 0
    assert len(lake.log.folders(f"{lake.path}/data")) == 1 and content(lake.read()) == whole(spark, 3)


def test_zone_maps_open_few_files(spark, tmp_path, monkeypatch):
    lake = SnapshotLake(spark, str(tmp_path / "lake"), batch(spark, 0).schema, zones=("ts",))
    for k in range(4):
        lake.append(batch(spark, k, 3000), k)
    # every file counts as small, and eight come out
    sizes = [r["bytes"] for r in lake.files().collect()]
    lake.target_bytes = sum(sizes) // 8
    monkeypatch.setattr(lake, "small_bytes", max(sizes) + 1)
    assert lake.compact() == len(sizes)
    files = lake.files().count()
    rows = lake.read()
    two = lake.plan("2024-03-10", "2024-03-11")
    assert files >= 7 and 0 < len(two) <= files // 2
    assert content(lake.read("2024-03-10", "2024-03-11")) == content(rows.where("day in (10, 11)"))
    lo, hi = dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 11, 23, 59, 59)
    assert set(lake.plan(within={"ts": (lo, hi)})) <= set(two)
    assert content(lake.read(within={"ts": (lo, hi)})) == content(rows.where("day in (10, 11)"))
    assert lake.read("2024-03-10", "2024-03-11").inputFiles() and len(lake.read("2024-03-10", "2024-03-11").inputFiles()) == len(two)
    # the hot day lies in several files
    assert len(lake.plan("2024-03-06", "2024-03-06")) > 1
    # a column without a zone map filters rows only
    assert content(lake.read(within={"v": (3, 4)})) == content(rows.where("v between 3 and 4"))
    assert content(lake.read("2031-01-01")) == []


def test_nulls_and_empty_batches(spark, lake):
    odd = batch(spark, 0, 3).withColumn("year", F.lit(None).cast("int")).withColumn("ts", F.lit(None).cast("timestamp"))
    lake.append(odd.limit(0), 0)
    lake.append(odd, 1)
    lake.append(batch(spark, 1, 3), 2)
    zone = [r for r in lake.files().collect() if r[f"lo_{DATE}"] is None]
    assert [(r["nulls_ts"], r[f"nulls_{DATE}"], r["rows"]) for r in zone] == [(3, 3, 3)]
    assert lake.read().count() == 6 and lake.read("2024-01-01").count() == 3
    assert lake.log.latest()[1]["batches"] == [[0, 2]]


def test_lists_are_merged(spark, lake, monkeypatch):
    from changelake.sinks import snapshots
    monkeypatch.setattr(snapshots, "MAX_LISTS", 2)
    for k in range(4):
        lake.append(batch(spark, k, 10), k)
    assert len(lake.log.latest()[1]["lists"]) <= 2 and content(lake.read()) == sorted(x for k in range(4) for x in content(batch(spark, k, 10)))


def test_two_writers_of_one_batch(spark, lake, monkeypatch):
    first = lake._doc

    def late(snapshot):
        doc = first(snapshot)
        monkeypatch.setattr(lake, "_doc", first)
        lake.append(batch(spark, 0, 5), 0)
        return doc

    monkeypatch.setattr(lake, "_doc", late)
    with pytest.raises(ManifestConflict):
        lake.append(batch(spark, 0, 5), 0)
    assert lake.read().count() == 5


def test_compaction_bounds_the_rows_a_task_sorts(spark, tmp_path):
    lake = SnapshotLake(spark, str(tmp_path / "lake"), batch(spark, 0).schema, zones=("ts", "v"), target_rows=1000)
    for k in range(5):
        lake.append(batch(spark, k), k)
    assert lake.compact() > 1
    sizes = [r["rows"] for r in lake.files().collect()]
    assert len(sizes) >= 2 and max(sizes) <= 1500 and sum(sizes) == 2000
    assert content(lake.read()) == whole(spark, 5)
    full = {r["file"] for r in lake.files().where("rows >= 500").collect()}
    lake.append(batch(spark, 5, 30), 5)
    lake.compact()
    assert full <= {r["file"] for r in lake.files().collect()}
