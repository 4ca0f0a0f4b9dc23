"""Row events, table-map lookups (against brute force), changelog."""

import json
import random

from pyspark.sql import functions as F

from changelake.operators import changelog as cl
from changelake.operators.joins import asof_lookup, checked_broadcast, member_join
from changelake.operators.rowevents import (
    classify_row_events,
    drop_no_event,
    explode_rows,
    lookup_table_map,
    lookup_table_map_static,
    raw_stream_form,
    row_event_json,
)
from changelake.schemas import ROW_EVENT_MESSAGE

EV_SCHEMA = ("position long, event_type string, table_id long, rows array<array<string>>, "
             "rows_after array<array<string>>, database string, table string")


def events(spark):
    return spark.createDataFrame(
        [
            (1, "INSERT", 5, [["1", "a"], ["2", None]], None, "db", "t"),
            (2, "UPDATE", 5, [["1", "a"]], [["1", "b"]], "db", "t"),
            (3, "DELETE", 5, [["2", None]], None, "db", "t"),
        ],
        EV_SCHEMA,
    )


def test_explode_and_json(spark):
    ex = explode_rows(events(spark))
    msgs = sorted(r.m for r in ex.select(row_event_json(ex).alias("m")).collect())
    assert msgs == sorted([
        '{"event":"INSERT","database":"db","table":"t","values":["1","a"]}',
        '{"event":"INSERT","database":"db","table":"t","values":["2",null]}',
        '{"event":"UPDATE","database":"db","table":"t","before":["1","a"],"after":["1","b"]}',
        '{"event":"DELETE","database":"db","table":"t","values":["2",null]}',
    ])
    raw = sorted(r.m for r in ex.select(row_event_json(ex, raw=True).alias("m")).collect())
    assert '{"event":"UPDATE","database":"db","table":"t","before":[1,a],"after":[1,b]}' in raw


def test_classify_and_raw_form(spark):
    df = spark.createDataFrame(
        [(1, "INSERT", 1, [["x"]], None), (2, "NO_EVENT", 0, [], None), (3, "ROTATE", 0, None, None),
         (4, "TABLE_MAP", 1, None, None), (5, "XID", 1, None, None)],
        "position long, event_type string, table_id long, rows array<array<string>>, rows_after array<array<string>>",
    )
    kinds = {r.position: r.kind for r in classify_row_events(drop_no_event(df)).collect()}
    assert kinds == {1: "row", 3: "ignored", 4: "map", 5: "unhandled"}
    from changelake.schemas import RAW_ROW_EVENT

    raw_df = raw_stream_form(df)
    assert [(f.name, f.dataType) for f in raw_df.schema.fields] == [(f.name, f.dataType) for f in RAW_ROW_EVENT.fields]
    raw = raw_df.collect()
    assert [(r.event_type, r.rows) for r in raw] == [("INSERT", '[["x"]]')]
    assert raw[0].event_time is not None


def brute_asof(evs, maps):
    out = {}
    for pos, tid in evs:
        cands = [m for m in maps if m[1] == tid and m[0] <= pos]
        best = max(cands, key=lambda m: m[0]) if cands else None
        out[pos] = (best[2], best[3]) if best else ("unknown_db", "unknown_table")
    return out


def test_asof_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    positions = rnd.sample(range(0, 5000), 1500)
    evs, maps = [], []
    for p in positions:
        tid = 1 if rnd.random() < 0.4 else rnd.randint(2, 20)  # one hot table id
        if rnd.random() < 0.15:
            maps.append((p, tid, f"db{tid}", f"t{p}"))
        else:
            evs.append((p, tid))
    ev_df = spark.createDataFrame(evs, "position long, table_id long")
    mp_df = spark.createDataFrame(maps, "position long, table_id long, database string, table string")
    expect = brute_asof(evs, maps)
    for width in (64, 1000, 1 << 20):
        got = {r.position: (r.database, r.table) for r in lookup_table_map(ev_df, mp_df, bucket_width=width).collect()}
        assert got == expect, width


def test_map_record_at_same_position_applies(spark):
    ev = spark.createDataFrame([(10, 1)], "position long, table_id long")
    mp = spark.createDataFrame([(10, 1, "d", "t")], "position long, table_id long, database string, table string")
    assert lookup_table_map(ev, mp).first().table == "t"


def test_asof_spreads_hot_key_over_buckets(spark):
    ev = spark.range(0, 10000).select(F.col("id").alias("position"), F.lit(1).cast("long").alias("table_id"))
    mp = spark.createDataFrame([(0, 1, "d")], "position long, table_id long, v string")
    plan = asof_lookup(ev, mp, "table_id", "position", ["v"], bucket_width=1000)
    assert plan.filter(F.col("v") == "d").count() == 10000
    # the row-level window is partitioned by (key, bucket), not key alone
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(table_id#" in text and "_bucket" in text


def test_static_lookup_defaults(spark):
    ev = spark.createDataFrame([(1, 5), (2, 6)], "position long, table_id long")
    mp = spark.createDataFrame([(5, "d", "t")], "table_id long, database string, table string")
    got = {r.position: (r.database, r.table) for r in lookup_table_map_static(ev, mp).collect()}
    assert got == {1: ("d", "t"), 2: ("unknown_db", "unknown_table")}


def test_checked_broadcast_respects_bounds(spark):
    small = spark.range(10)
    big = spark.range(100000)
    assert "broadcast" in checked_broadcast(small)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in checked_broadcast(big, max_rows=1000)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in checked_broadcast(small, max_bytes=10)._jdf.queryExecution().analyzed().toString().lower()


def test_member_join(spark):
    left = spark.createDataFrame([(1, [1, 3]), (2, [2])], "k long, wanted array<int>")
    right = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "d"), (2, 2, "e")],
                                  "k long, n int, v string")
    got = sorted((r.k, r.n, r.v) for r in member_join(left, right, "k", "n", "wanted").collect())
    assert got == [(1, 1, "a"), (1, 3, "c"), (2, 2, "e")]


def test_changelog_from_row_events(spark):
    ex = explode_rows(events(spark))
    parsed = ex.select(F.from_json(row_event_json(ex), ROW_EVENT_MESSAGE).alias("m")).select("m.*")
    got = sorted((r.op, r.record_key, r.before, r.after) for r in cl.from_row_events(parsed).collect())
    assert got == sorted([
        ("I", "1", None, '["1","a"]'),
        ("I", "2", None, '["2",null]'),
        ("U", "1", '["1","a"]', '["1","b"]'),
        ("D", "2", '["2",null]', None),
    ])


def test_changelog_union_of_forms(spark):
    env = spark.createDataFrame(
        [(None, {"id": "1"}, "c", 10), ({"id": "1"}, None, "d", 20)],
        "before struct<id:string>, after struct<id:string>, op string, ts_ms long",
    )
    pub = spark.createDataFrame([("db", "t", "2", "U", '{"id":"2"}', 3)],
                                "db_name string, table_name string, record_id string, operation string, "
                                "new_data string, timestamp_epoch long")
    out = cl.to_changelog(cl.from_envelope(env, "db", "t", "id"), cl.from_publish(pub))
    got = sorted((r.form, r.record_key, r.op, r.ts_ms) for r in out.collect())
    assert got == [("envelope", "1", "D", 20), ("envelope", "1", "I", 10), ("publish", "2", "U", 3000)]
    assert json.loads([r for r in out.collect() if r.op == "D"][0].before) == {"id": "1"}


def test_static_lookup_refuses_repeated_ids(spark):
    import pytest

    ev = spark.createDataFrame([(1, 5)], "position long, table_id long")
    mp = spark.createDataFrame([(5, "d", "t"), (5, "d2", "t2")], "table_id long, database string, table string")
    with pytest.raises(ValueError, match="table map"):
        lookup_table_map_static(ev, mp)


def test_asof_null_key_or_position_gets_defaults(spark):
    ev = spark.createDataFrame([(1, None), (None, 5), (3, 5)], "position long, table_id long")
    mp = spark.createDataFrame([(0, None, "dn", "tn"), (None, 5, "dx", "tx"), (2, 5, "d", "t")],
                               "position long, table_id long, database string, table string")
    got = {((r.position, r.table_id), (r.database, r.table))
           for r in lookup_table_map(ev, mp, bucket_width=2).collect()}
    assert got == {((1, None), ("unknown_db", "unknown_table")),
                   ((None, 5), ("unknown_db", "unknown_table")),
                   ((3, 5), ("d", "t"))}


def test_table_map_static_looks_up_the_whole_map(spark, tmp_path):
    """Every segment's tables are found, a user without one gets the defaults; the SQL gives the same."""
    import duckdb

    from changelake.plans.oracle import oracle_sql
    from changelake.plans.queries import table_map_static

    spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, None)], "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    customers = [(7, "seven", "BUILDING"), (8, "eight", "MACHINERY")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    found = [(1, 7, "BUILDING", "seven"), (2, 8, "MACHINERY", "eight"), (3, 9, "unknown_db", "unknown_table"),
             (4, None, "unknown_db", "unknown_table")]
    assert sorted(tuple(r) for r in table_map_static(spark, str(tmp_path)).collect()) == found
    con = duckdb.connect()
    for t in ("customer", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(oracle_sql()["table_map_static"]).fetchall()) == found
