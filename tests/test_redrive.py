"""Re-drive of the quarantine: versions in order, odd messages, lost runs, later batches."""

import json

import duckdb
import pytest
from pyspark.sql import types as T

from changelake.operators.envelope import add_date_parts, flag_bad, good_rows
from changelake.plans.oracle import oracle_sql
from changelake.session import scratch_path
from changelake.sinks.lake import write_batch
from changelake.sinks.redrive import MessageVersion, Redrive, decode_versions

ROW = T.StructType().add("id", "long").add("name", "string")
V2 = MessageVersion("v2", "$.payload.old", "$.payload.new", "$.payload.kind", "$.payload.at", {"name": "label"})
V3 = MessageVersion("v3", "$.b", "$.a", "$.o", "$.t")
DAY = 86_400_000


def v2(i, at=DAY, **new):
    return json.dumps({"payload": {"new": {"id": i, "label": f"n{i}", **new}, "kind": "c", "at": at}})


def v3(i):
    return json.dumps({"a": {"id": i, "name": f"n{i}"}, "o": "u", "t": 2 * DAY})


def messages(spark, rows):
    return spark.createDataFrame(rows, "key string, message string")


def decoded(spark, text, *versions):
    got = decode_versions(messages(spark, [("k", text)]), ROW, versions, ["key"]).first().decoded
    return got and (got.version, got.after and tuple(got.after), got.op, got.ts_ms)


def test_versions_in_order_and_odd_messages(spark):
    assert decoded(spark, v2(1), V2, V3) == ("v2", (1, "n1"), "c", DAY)
    assert decoded(spark, v3(1), V2, V3) == ("v3", (1, "n1"), "u", 2 * DAY)
    same = MessageVersion("same", V3.before, V3.after, V3.op, V3.ts_ms)
    assert decoded(spark, v3(1), same, V3)[0] == "same"
    assert decoded(spark, v2(1, label=None), V2) == ("v2", (1, None), "c", DAY)
    for text in (None, "", "{", "[]", "7", "null", '{"payload":null}', v2("x"), v2(1, at=None), v2(1, at=2**63 - 1),
                 v2(1, at="soon"), '{"payload":{"new":5,"kind":"c","at":1}}', '{"payload":{"kind":"c","at":1}}', v3(1)):
        assert decoded(spark, text, V2) is None, text
    long_name = "x" * 1_000_000
    assert decoded(spark, v2(1, label=long_name), V2)[1] == (1, long_name)
    assert decode_versions(messages(spark, []), ROW, [V2], ["key"]).collect() == []


class Folders:
    def __init__(self, spark):
        root = scratch_path(spark, "t-redrive")
        self.spark, self.lake, self.quarantine = spark, f"{root}/lake", f"{root}/bad"
        self.redrive = Redrive(spark, self.lake, self.quarantine, f"{root}/state")

    def land(self, batch, rows):
        flagged = flag_bad(messages(self.spark, rows).withColumnRenamed("message", "value"), ROW, keep=("key",))
        write_batch(add_date_parts(good_rows(flagged, ("key",))), flagged.where("bad_reason is not null").select("key", "message", "bad_reason"),
                    batch, self.lake, self.quarantine)

    def moved(self):
        return sorted(r.key for r in self.spark.read.schema("key string, op string, year int, month int, day int, batch_id int")
                      .parquet(self.lake).collect())

    def left(self):
        return sorted(r.key for r in self.redrive.read_quarantine().collect())


def test_each_message_moves_once_over_lost_runs(spark, monkeypatch):
    f = Folders(spark)
    f.land(0, [("a", v2(1)), ("b", v3(2)), ("c", "{"), ("a", v2(1))])
    f.land(1, [("d", v2(4)), ("e", None)])
    assert f.left() == ["a", "a", "b", "c", "d", "e"]

    def lost():
        raise OSError("lost")

    with pytest.raises(OSError):  # written, not closed
        f.redrive.run(ROW, [V2], ("key",), before_close=lost)
    assert f.left() == ["a", "a", "b", "c", "d", "e"]
    # the lost run is done again by its own versions and batches, then the rest and the new batch by both
    f.land(2, [("g", v3(7))])
    f.redrive.run(ROW, [V2, V3], ("key",))
    assert f.moved() == ["a", "a", "b", "d", "g"] and f.left() == ["c", "e"]

    commit, calls = f.redrive.log.commit, []

    def second_fails(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost at the close")
        return commit(*args)

    f.land(3, [("h", v2(8)), ("i", "[")])
    monkeypatch.setattr(f.redrive.log, "commit", second_fails)
    with pytest.raises(OSError):
        f.redrive.run(ROW, [V2], ("key",))
    f.redrive.run(ROW, [V2], ("key",))
    f.redrive.run(ROW, [V2], ("key",))
    assert f.moved() == ["a", "a", "b", "d", "g", "h"] and f.left() == ["c", "e", "i"]
    assert sorted({r.bad_reason for r in f.redrive.read_quarantine().collect()}) == ["corrupt", "tombstone"]


def test_fixtures_hold_what_the_rules_are_for(sf_dir):
    """NULL keys and every reason of a bad message are among the expected rows."""
    con = duckdb.connect()
    for t in ("customer", "lineitem", "events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    sql = oracle_sql()
    assert con.execute(f"SELECT count(*) FROM ({sql['key_violations']}) WHERE violation = 'null_key'").fetchone()[0] == 1
    reasons = con.execute(f"SELECT DISTINCT reason FROM ({sql['bad_message_split']}) WHERE reason IS NOT NULL").fetchall()
    assert {r for r, in reasons} == {"corrupt", "tombstone", "no_payload", "no_ts_ms", "ts_ms_out_of_range"}
