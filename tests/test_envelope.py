"""Envelope decode and the bad-message split on hand-written edge rows."""

from pyspark.sql import types as T

from changelake.operators.envelope import add_date_parts, decode_envelope, split_bad

ROW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MESSAGES = [
    ("ok", '{"payload":{"before":null,"after":{"id":"a","amount":"1.50","timestamp":5},"op":"c","ts_ms":1717200000123}}'),
    ("null_payload", '{"payload":null}'),
    ("garbage", "garbage"),
    ("tombstone", None),
    ("other", '{"other":1}'),
    ("no_ts", '{"payload":{"after":{"id":"b"},"op":"d"}}'),
    ("types", '{"payload":{"after":{"id":"c","amount":10.5,"timestamp":"x"},"op":"u","ts_ms":1}}'),
    ("extra", '{"payload":{"after":{"id":"d","zzz":1},"op":"r","ts_ms":2},"schema":{}}'),
]


def messages(spark):
    return spark.createDataFrame(MESSAGES, "k string, value string")


def test_split_bad_classifies_edge_rows(spark):
    good, bad = split_bad(messages(spark), ROW, keep=("k",))
    reasons = {r.k: r.bad_reason for r in bad.collect()}
    assert reasons == {
        "null_payload": "no_payload",
        "garbage": "corrupt",
        "tombstone": "tombstone",
        "other": "no_payload",
        "no_ts": "no_ts_ms",
        "types": "corrupt",
    }
    got = {r.k: r for r in good.collect()}
    assert set(got) == {"ok", "extra"}
    assert got["ok"].after.amount == "1.50" and got["ok"].op == "c"
    assert got["extra"].after.id == "d"  # unknown fields dropped


def test_number_for_string_survives_as_text(spark):
    dec = decode_envelope(messages(spark), ROW, keep=("k",), keep_bad=True)
    r = {x.k: x for x in dec.collect()}["types"]
    assert r.after.amount == "10.5"
    assert r.after.timestamp is None


def test_keep_bad_restores_all_rows(spark):
    assert decode_envelope(messages(spark), ROW, keep_bad=True).count() == len(MESSAGES)
    assert decode_envelope(messages(spark), ROW).count() == 3  # ok, no_ts (dated later), extra


def test_date_parts_on_decoded(spark):
    good, _ = split_bad(messages(spark), ROW, keep=("k",))
    rows = {r.k: (r.year, r.month, r.day) for r in add_date_parts(good).collect()}
    assert rows["ok"] == (2024, 6, 1)
    rows_mx = {r.k: (r.year, r.month, r.day) for r in add_date_parts(good, tz="America/Mexico_City").collect()}
    assert rows_mx["ok"] == (2024, 5, 31)


def test_decode_parses_each_message_once(spark):
    plan = decode_envelope(messages(spark), ROW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_alias_map_accepts_both_key_spellings(spark):
    from changelake.schemas import TRANSACTION_ALIASES, TRANSACTION_ROW

    msgs = spark.createDataFrame(
        [
            ("lower", '{"payload":{"after":{"transaction_id":"1","affiliateid":"x"},"op":"c","ts_ms":1}}'),
            ("camel", '{"payload":{"after":{"transaction_id":"2","affiliateId":"y"},"op":"c","ts_ms":1}}'),
            ("delete", '{"payload":{"before":{"transaction_id":"3","affiliateId":"z"},"after":null,"op":"d","ts_ms":1}}'),
            ("bad", "{not json"),
        ],
        "k string, value string",
    )
    good, bad = split_bad(msgs, TRANSACTION_ROW, keep=("k",), aliases=TRANSACTION_ALIASES)
    got = {r.k: r for r in good.collect()}
    assert got["lower"].after.affiliateid == "x"
    assert got["camel"].after.affiliateid == "y"
    assert got["delete"].after is None and got["delete"].before.affiliateid == "z"
    assert got["camel"].after.__fields__ == TRANSACTION_ROW.fieldNames()
    assert [r.k for r in bad.collect()] == ["bad"]
    plain = {r.k: r for r in decode_envelope(msgs, TRANSACTION_ROW, keep=("k",)).collect()}
    assert plain["camel"].after.affiliateid is None  # without the alias map the key is missed
