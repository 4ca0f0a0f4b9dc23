"""The ledger of sorted runs."""

import pytest
from pyspark.sql import functions as F

from changelake.sinks.lake import path_exists
from changelake.sinks.ledger import outbox_part
from changelake.sinks.manifest import ManifestConflict, ManifestLog, joined
from changelake.sinks.runs import RunLedger, publish_once


def ids(spark, a, b):
    return spark.range(a, b).select(F.sha2(F.col("id").cast("string"), 256).alias("audit_log_id"))


@pytest.fixture()
def ledger(spark, tmp_path):
    return RunLedger(spark, str(tmp_path / "ledger"), fanout=3)


def test_many_batches_leave_few_runs(spark, ledger):
    for k in range(20):
        assert ledger.append(ids(spark, k * 10, k * 10 + 10), k)
    # 20 in base 3 is 202
    assert len(ledger.runs()) == 4 and ledger.batches() == [[0, 19]] and ledger.next_batch() == 20
    assert sum(r["n"] for r in ledger.runs()) == 200 == ledger.ids().distinct().count()
    left = ledger.absent(ids(spark, 150, 260))
    assert sorted(r[0] for r in left.collect()) == sorted(r[0] for r in ids(spark, 200, 260).collect())
    assert len(ledger.vacuum()) > 0 and ledger.ids().count() == 200


def test_only_runs_that_may_match_are_opened(spark, ledger):
    for k in range(2):
        ledger.append(ids(spark, k * 5000, k * 5000 + 5000), k)
    ledger.seen(ids(spark, 10, 20)).collect()
    first = [r["run"] for r in ledger.runs() if r["batches"] == [[0, 0]]]
    assert ledger.opened == first
    ledger.seen(ids(spark, 1_000_000, 1_000_010)).collect()
    assert ledger.opened == []
    # 8 bits of 16 an id: few of those never added pass
    assert ledger._maybe(ids(spark, 20_000, 40_000).withColumnRenamed("audit_log_id", "id"), ledger.runs()).count() < 0.005 * 40_000


def test_replay_during_a_merge_loses_nothing(spark, ledger):
    for k in range(3):
        ledger.append(ids(spark, k * 10, k * 10 + 10), k, merge=False)

    def replay():
        assert ledger.append(ids(spark, 10, 20), 1, merge=False) is False
        assert ledger.append(ids(spark, 30, 40), 3, merge=False)

    assert ledger.merge(replay) == 1
    assert sorted(r["level"] for r in ledger.runs()) == [0, 1] and ledger.batches() == [[0, 3]]
    assert ledger.absent(ids(spark, 0, 41)).count() == 1


def test_crash_in_a_merge_leaves_the_ledger_as_it_was(spark, ledger):
    for k in range(3):
        ledger.append(ids(spark, k * 10, k * 10 + 10), k, merge=False)
    before = ledger.runs()

    def crash():
        raise OSError("lost")

    with pytest.raises(OSError):
        ledger.merge(crash)
    assert ledger.runs() == before and ledger.absent(ids(spark, 0, 30)).isEmpty()
    assert len(ledger.vacuum()) == 1
    assert ledger.merge() == 1 and ledger.absent(ids(spark, 0, 30)).isEmpty()


def test_batch_number_of_other_ids_is_refused(spark, ledger):
    ledger.append(ids(spark, 0, 5), 7)
    with pytest.raises(ValueError, match="other ids"):
        ledger.append(ids(spark, 0, 6), 7)


def test_publish_once_clears_the_outbox_and_sends_again_after_a_crash(spark, ledger):
    sent = []

    def sink(df):
        sent.append(sorted(r[0] for r in df.collect()))

    def broken(df):
        raise OSError("no topic")

    with pytest.raises(OSError):
        publish_once(ids(spark, 0, 5), 0, broken, ledger)
    assert ledger.runs() == [] and path_exists(spark, outbox_part(ledger.path, 0))
    assert publish_once(ids(spark, 0, 5), 0, sink, ledger) and not path_exists(spark, outbox_part(ledger.path, 0))
    assert publish_once(ids(spark, 0, 5), 0, sink, ledger) is False and len(sent) == 1


def test_odd_ids(spark, ledger):
    odd = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "audit_log_id string")
    ledger.append(odd, 0)
    ledger.append(odd.limit(0), 1)
    assert sorted(r[0] for r in ledger.ids().collect()) == ["", "a"]
    extra = odd.withColumn("run", F.lit(1)).withColumn("block", F.lit(2)).withColumn("id", F.lit(3))
    assert [tuple(r) for r in ledger.absent(extra).collect()] == [(None, 1, 2, 3)]


def test_manifest_conflict_and_retention(spark, tmp_path):
    log = ManifestLog(spark, str(tmp_path / "m"), keep=2)
    assert log.latest() == (0, None)
    for k in range(4):
        assert log.commit(k, {"k": k}) == k + 1
    assert log.numbers() == [3, 4] and log.latest() == (4, {"k": 3})
    with pytest.raises(ManifestConflict):
        log.commit(3, {"k": "late"})
    assert log.latest() == (4, {"k": 3})
    assert joined([[5, 6], [1, 2], [3, 3], [9, 9]]) == [[1, 3], [5, 6], [9, 9]]


def test_many_asked_ids_are_told_in_one_join(spark, ledger, monkeypatch):
    """The rows are shuffled once, the runs' ids once; ids of any form, and rows without one, are kept as they are."""
    from changelake.sinks import runs as module

    monkeypatch.setattr(module, "DEFAULT_MAX_BROADCAST_ROWS", 10, raising=False)
    odd = ["", "x", "A" * 64, "a" * 64, "a" * 64 + "\n", "é"]
    known = ids(spark, 0, 100).unionByName(spark.createDataFrame([(x,) for x in odd[:4]], "audit_log_id string"))
    ledger.append(known, 0)
    asked = ids(spark, 50, 120).unionByName(spark.createDataFrame([(x,) for x in [*odd, None, None]], "audit_log_id string"))
    asked = asked.select(F.lit(1).alias("v"), "audit_log_id").repartition(2)
    left = ledger.absent(asked)
    assert left._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # noqa: SLF001
    want = [(1, r[0]) for r in ids(spark, 100, 120).collect()] + [(1, x) for x in odd[4:]] + [(1, None)] * 2
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, want))
    assert sorted(r[0] for r in ledger.seen(asked).distinct().collect()) == sorted([r[0] for r in ids(spark, 50, 100).collect()] + odd[:4])


def test_the_outbox_of_a_poll_holds_rows_not_messages(spark, tmp_path):
    """Messages are rendered from the written rows; a poll without rows takes no number."""
    from changelake.operators.audit import capture_changes
    from changelake.plans.jobs import poll_audit_once, poll_audit_runs

    old = spark.range(0).select("id", F.lit("x").alias("v"))
    new = spark.range(5).select("id", F.lit("x").alias("v"))
    audit = capture_changes(old, new, "id", version="v1")
    ledger, plain = RunLedger(spark, str(tmp_path / "l")), str(tmp_path / "p")

    def broken(df):
        raise OSError("no topic")

    for poll, path in ((lambda send: poll_audit_runs(audit, send, ledger), ledger.path), (lambda send: poll_audit_once(audit, send, plain), plain)):
        with pytest.raises(OSError):
            poll(broken)
        kept = spark.read.parquet(outbox_part(path, 0))
        assert kept.count() == 5 and "new_data" in kept.columns and not {"value", "topic", "old_data"} & set(kept.columns)
        sent = []
        poll(lambda df: sent.extend(r["key"] for r in df.collect()))
        assert sorted(sent) == ["0", "1", "2", "3", "4"]
    assert poll_audit_runs(audit, broken, ledger) is False and ledger.next_batch() == 1
    assert not path_exists(spark, outbox_part(ledger.path, 1))
