"""Column helpers: hashes, epoch seconds, zones, JSON text."""

import hashlib

from pyspark.sql import functions as F

from changelake.functions import (
    date_parts,
    date_text,
    epoch_seconds,
    hash_id,
    hash_pk,
    hash_record,
    json_field,
    row_json,
    sha256_hex,
    values_text,
)


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def test_sha256_matches_hashlib(spark):
    row = spark.sql("select 'héllo' as s").select(sha256_hex("s").alias("h")).first()
    assert row.h == sha("héllo")


def test_hash_keys_concatenate_without_separator(spark):
    df = spark.sql("select 'POSTGRESQL' t, 'db' d, 'tbl' n, '42' r, 1700000000L s, '{\"a\":1}' j")
    r = df.select(
        hash_id("t", "d", "n", "r").alias("hid"),
        hash_pk("t", "d", "n", "r", "s").alias("hpk"),
        hash_record("j").alias("hr"),
        hash_id("t", "d", "n", "r", sep="|").alias("hid_sep"),
    ).first()
    assert r.hid == sha("POSTGRESQLdbtbl42")
    assert r.hpk == sha("POSTGRESQLdbtbl421700000000")
    assert r.hr == sha('{"a":1}')
    assert r.hid_sep == sha("POSTGRESQL|db|tbl|42")


def test_null_parts_render_as_text_null(spark):
    df = spark.sql("select 'P' t, cast(null as string) d, 'x' n, '1' r, cast(null as string) j")
    r = df.select(hash_id("t", "d", "n", "r").alias("h"), hash_record("j").alias("hr")).first()
    assert r.h == sha("Pnullx1")
    assert r.hr is None  # a delete has no new image and no content key


def test_epoch_seconds_truncates_toward_zero(spark):
    df = spark.sql(
        "select timestamp_ntz'1969-12-31 23:59:58.5' n, timestamp_ntz'2024-06-01 00:00:01.9' p"
    )
    r = df.select(epoch_seconds("n", ntz=True).alias("n"), epoch_seconds("p", ntz=True).alias("p")).first()
    assert r.n == -1
    assert r.p == 1717200001


def test_epoch_seconds_of_instant_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
        r = spark.sql("select timestamp_millis(1717200000123L) t").select(epoch_seconds("t").alias("s")).first()
        assert r.s == 1717200000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_zone_edge_date_parts(spark):
    df = spark.sql("select 1717200000123L ms")
    utc = df.select(*[c.alias(k) for k, c in date_parts("ms").items()], date_text("ms").alias("d")).first()
    mx = df.select(*[c.alias(k) for k, c in date_parts("ms", "America/Mexico_City").items()],
                   date_text("ms", "America/Mexico_City").alias("d")).first()
    assert (utc.year, utc.month, utc.day, utc.d) == (2024, 6, 1, "2024-06-01")
    assert (mx.year, mx.month, mx.day, mx.d) == (2024, 5, 31, "2024-05-31")


def test_date_parts_do_not_follow_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        r = spark.sql("select 1717200000123L ms").select(date_parts("ms")["day"].alias("d")).first()
        assert r.d == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_row_json_keeps_nulls_and_order(spark):
    df = spark.sql("select 1 as b, cast(null as string) as a, cast(2.5 as decimal(18,2)) as m")
    assert df.select(row_json().alias("j")).first().j == '{"b":1,"a":null,"m":2.50}'
    assert df.select(row_json(["m", "a"]).alias("j")).first().j == '{"m":2.50,"a":null}'


def test_values_text_json_and_raw(spark):
    df = spark.sql("select array('1', 'x', null) v")
    r = df.select(values_text("v").alias("j"), values_text("v", raw=True).alias("r")).first()
    assert r.j == '["1","x",null]'
    assert r.r == "[1,x,null]"


def test_json_field_missing_and_bad(spark):
    df = spark.createDataFrame([('{"valor": 7}',), ('{"other": 1}',), ('{"valor": "x"}',)], "m string")
    got = [r.v for r in df.select(json_field("m", "valor", "int").alias("v")).collect()]
    assert got == [7, None, None]


def test_hash_keys_do_not_depend_on_partitioning(spark):
    base = spark.range(0, 2000).select(F.col("id").cast("string").alias("r"))
    def keys(df):
        return sorted(
            (r.r, r.h) for r in df.select("r", hash_id(F.lit("P"), F.lit("d"), F.lit("t"), "r").alias("h")).collect()
        )
    assert keys(base.repartition(1)) == keys(base.repartition(7))


def test_ntz_arithmetic_ignores_dst_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("select timestamp_ntz'2024-07-01 00:00:00.250' t, 1719792000250L ms")
        r = df.select(epoch_millis_("t"), date_text("ms").alias("d"), date_parts("ms")["day"].alias("day")).first()
        assert (r.em, r.d, r.day) == (1719792000250, "2024-07-01", 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def epoch_millis_(c):
    from changelake.functions import epoch_millis

    return epoch_millis(c, ntz=True).alias("em")


def test_epoch_units_and_variant(spark):
    from changelake.functions import as_variant, ntz_from_epoch

    df = spark.sql("select 1717200000L s, 1717200000123L ms, '{\"a\":{\"b\":7}}' j, 'nope' bad")
    r = df.select(ntz_from_epoch("s", "s").alias("a"), ntz_from_epoch("ms").alias("b"),
                  F.variant_get(as_variant("j"), "$.a.b", "int").alias("v"),
                  as_variant("bad").isNull().alias("nul")).first()
    assert str(r.a) == "2024-06-01 00:00:00" and str(r.b) == "2024-06-01 00:00:00.123000"
    assert r.v == 7 and r.nul


def test_json_topic_records_decode_from_bytes(spark):
    from changelake.schemas import SIMPLE_MESSAGE
    from changelake.sources.kafka import read_json_topic

    recs = spark.createDataFrame([(b"k", bytearray(b'{"valor": 4}'), 0), (None, bytearray(b'{"valor": 9}'), 1)],
                                 "key binary, value binary, offset long")
    got = sorted((r.offset, r.valor) for r in read_json_topic(recs, SIMPLE_MESSAGE, keep=("offset",)).collect())
    assert got == [(0, 4), (1, 9)]


def test_apply_recommended_keeps_explicit_settings(spark):
    from changelake.session import RECOMMENDED_SQL_CONF, apply_recommended

    apply_recommended(spark)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        assert spark.conf.get(key) in (RECOMMENDED_SQL_CONF[key], str(-1))
