"""Change-data fixtures derived with Spark from the given tables.

Every fixture is a projection (or a keyed join/aggregation) of a whole
table, so its size grows with the table.  Rules (see FIXTURES.md):

* ``orders`` plays the source table; its row image keeps money as
  DECIMAL(18,2) and the order date as ``yyyy-MM-dd HH:mm:ss`` text.
* before/after envelopes: status O -> ``c``, F -> ``u`` (before = the same
  order still open, status O), P -> ``d``; ``ts_ms`` from the order date.
* two table versions: priority ``1-URGENT`` rows exist only in the new
  version (inserts), ``5-LOW`` only in the old one (deletes); ``2-HIGH``
  rows cost 1 more in the new version and open ``3-MEDIUM`` orders are
  fulfilled (updates).
* row events: lineitems grouped per (order, linenumber block of 4); the
  order status gives INSERT (O), UPDATE (F, before = line status O), DELETE.
* table map: ``events`` of type ``error`` are map records (table id =
  user id, position = event id), the other events are row events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.jsoncols import money
from changelake.functions.timecols import epoch_millis, seconds_text
from changelake.operators.audit import capture_changes

# Fixed values of the fixtures (ours).
DB_NAME = "tpch"
ORDERS_TABLE = "orders"
LINEITEM_TABLE = "lineitem"
CAPTURED_AT_MS = 1717243200000  # 2024-06-01 12:00:00 UTC, time of the second snapshot
VERSION = "v2"
EVENT_BLOCK = 4  # rows per landed row event

ORDER_ENVELOPE_ROW = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.StringType()),
        T.StructField("o_orderdate", T.LongType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)

EVENT_ENVELOPE_ROW = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- orders ---

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def order_rows(orders: DataFrame, *extra) -> DataFrame:
    """Orders as the source table (JSON-stable types), plus ``extra`` columns."""
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        seconds_text("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
        *extra,
    )


def _order_image(status=None):
    return F.struct(
        F.col("o_orderkey"),
        F.col("o_custkey"),
        (status if status is not None else F.col("o_orderstatus")).alias("o_orderstatus"),
        money("o_totalprice").cast("string").alias("o_totalprice"),
        epoch_millis("o_orderdate", ntz=True).alias("o_orderdate"),
        F.col("o_orderpriority"),
    )


def order_envelopes(orders: DataFrame, *extra: str) -> DataFrame:
    """``key, value`` before/after change messages of every order."""
    st = F.col("o_orderstatus")
    op = F.when(st == "O", F.lit("c")).when(st == "F", F.lit("u")).otherwise(F.lit("d"))
    before = F.when(st == "F", _order_image(F.lit("O"))).when(st == "O", F.lit(None)).otherwise(_order_image())
    after = F.when(st.isin("O", "F"), _order_image())
    payload = F.struct(
        before.alias("before"),
        after.alias("after"),
        op.alias("op"),
        epoch_millis("o_orderdate", ntz=True).alias("ts_ms"),
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.to_json(F.struct(payload.alias("payload"))).alias("value"),
        *extra,
    )


def order_messages(orders: DataFrame) -> DataFrame:
    """Order envelopes whose partly shipped orders (status P) are unusable in
    five ways, by priority: no message, cut short, no payload, no time, and a
    time that no date has."""
    late = F.regexp_replace("value", r'"ts_ms":-?\d+', '"ts_ms":9223372036854775807')
    value = (
        F.when(F.col("o_orderstatus") != "P", F.col("value"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("string"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.expr("left(value, length(value) div 2)"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit('{"schema":"orders"}'))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.regexp_replace("value", r',"ts_ms":-?\d+', ""))
        .otherwise(late)
    )
    return order_envelopes(orders, "o_orderstatus", "o_orderpriority").select("key", value.alias("value"))


def order_messages_by_version(orders: DataFrame) -> DataFrame:
    """:func:`order_messages` whose updates (status F) are of later schemas: urgent ones below ``change`` instead of
    ``payload``, the others with new names; of these the ones of high priority hold a customer that is no number."""
    value = F.col("value")
    renamed = value
    for old, new in (('"before":', '"old":'), ('"after":', '"new":'), ('"op":', '"kind":'), ('"ts_ms":', '"at":'), ('"o_totalprice":', '"price":')):
        renamed = F.replace(renamed, F.lit(old), F.lit(new))
    pr = F.col("o_orderpriority")
    later = (F.when(pr == "1-URGENT", F.replace(value, F.lit('{"payload":'), F.lit('{"change":')))
             .when(pr == "2-HIGH", F.regexp_replace(renamed, r'"o_custkey":-?\d+', '"o_custkey":"none"')).otherwise(renamed))
    updates = order_envelopes(orders, "o_orderstatus", "o_orderpriority").where("o_orderstatus = 'F'")
    return order_messages(orders.where("o_orderstatus <> 'F'")).unionByName(updates.select("key", later.alias("value")))


def order_versions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, new) versions of the orders table."""
    rows = order_rows(orders)
    pr = F.col("o_orderpriority")
    old = rows.filter(pr != "1-URGENT")
    new = rows.filter(pr != "5-LOW").select(
        "o_orderkey",
        "o_custkey",
        F.when((pr == "3-MEDIUM") & (F.col("o_orderstatus") == "O"), F.lit("F"))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(pr == "2-HIGH", F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return old, new


def order_third_version(new: DataFrame) -> DataFrame:
    """The version after ``new``: its ``2-HIGH`` orders cost 2 more again."""
    dearer = F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 2).otherwise(F.col("o_totalprice"))
    return new.withColumn("o_totalprice", dearer.cast("decimal(18,2)"))


LAKE_RANGE_MS = (820454400000, 825551999999)  # 1996-01-01 to 1996-02-28, the range read from the lake of snapshots
KEY_TABLES = {  # tables whose keys are looked for, with their columns
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
}
RARE_WIDTH = 256  # keys of a range in the versions with few changes


def order_rare_versions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, new) versions that differ in few ranges of the key: in every 16th range of 256 keys,
    one key in 50 is new, one has gone and one costs 1 more."""
    rows = order_rows(orders)
    key = F.col("o_orderkey")
    ranged = F.pmod(F.expr(f"o_orderkey div {RARE_WIDTH}"), F.lit(16)) == 3
    kind = F.pmod(key, F.lit(50))
    old = rows.filter(~(ranged & (kind == 1)))
    dearer = F.when(ranged & (kind == 3), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = rows.filter(~(ranged & (kind == 2))).withColumn("o_totalprice", dearer.cast("decimal(18,2)"))
    return old, new


def customer_versions(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old, new) versions of the customers: nation 1 comes in, nation 2 goes."""
    rows = customer.select("c_custkey", "c_name", "c_nationkey")
    return rows.filter("c_nationkey <> 1").drop("c_nationkey"), rows.filter("c_nationkey <> 2").drop("c_nationkey")


def captured_at():
    return F.timestamp_millis(F.lit(CAPTURED_AT_MS))


def order_audit(orders: DataFrame, cols=None) -> DataFrame:
    """Audit rows between the two order versions."""
    old, new = order_versions(orders)
    return capture_changes(old, new, "o_orderkey", cols=cols, db_name=DB_NAME,
                           table_name=ORDERS_TABLE, captured_at=captured_at(), version=VERSION)


def order_inserts(orders: DataFrame) -> DataFrame:
    """Initial load: every order as an inserted audit row stamped with its
    order date (TIMESTAMP_NTZ, read as UTC)."""
    rows = order_rows(orders, F.col("o_orderdate").alias("_ts"))
    image = F.to_json(F.struct(*[F.col(c) for c in ORDER_COLUMNS]), {"ignoreNullFields": "false"})
    rid = F.col("o_orderkey").cast("string")
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(DB_NAME), F.lit(ORDERS_TABLE), rid, F.lit("I")), 256).alias("audit_log_id"),
        F.lit(DB_NAME).alias("db_name"),
        F.lit(ORDERS_TABLE).alias("table_name"),
        rid.alias("record_id"),
        F.lit("I").alias("operation"),
        F.lit(None).cast("string").alias("old_data"),
        image.alias("new_data"),
        F.col("_ts").alias("timestamp"),
    )


# -------------------------------------------------------------- row events ---

LINE_FIELDS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _line_values(r, status=None):
    """Row values of a lineitem struct as text (money as DECIMAL(18,2))."""
    return F.array(
        r["l_orderkey"].cast("string"),
        r["l_partkey"].cast("string"),
        r["l_suppkey"].cast("string"),
        r["l_linenumber"].cast("string"),
        money(r["l_quantity"]).cast("string"),
        money(r["l_extendedprice"]).cast("string"),
        money(r["l_discount"]).cast("string"),
        money(r["l_tax"]).cast("string"),
        r["l_returnflag"],
        status if status is not None else r["l_linestatus"],
        F.date_format(r["l_shipdate"], "yyyy-MM-dd"),
    )


def lineitem_row_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Landed row events: one event per (order, block of EVENT_BLOCK lines).

    Every group is bounded by EVENT_BLOCK distinct line numbers, so no
    collect gathers an unbounded group.  Raw columns are collected and
    rendered to text after the shuffle, spread over all its partitions.
    """
    st = orders.select("o_orderkey", "o_orderstatus")
    li = lineitem.join(st, lineitem.l_orderkey == st.o_orderkey, "inner")
    ev = F.when(F.col("o_orderstatus") == "O", F.lit("INSERT")).when(
        F.col("o_orderstatus") == "F", F.lit("UPDATE")
    ).otherwise(F.lit("DELETE"))
    li = li.select(
        "l_orderkey",
        ((F.col("l_linenumber") - 1) / EVENT_BLOCK).cast("long").alias("_block"),
        ev.alias("event_type"),
        F.struct(*[F.col(c) for c in LINE_FIELDS]).alias("_r"),
    )
    grouped = li.groupBy("l_orderkey", "_block", "event_type").agg(F.collect_list("_r").alias("_rs"))
    is_update = F.col("event_type") == "UPDATE"
    return grouped.select(
        (F.col("l_orderkey") * 1024 + F.col("_block")).alias("position"),
        "event_type",
        F.lit(1).cast("long").alias("table_id"),
        F.when(is_update, F.transform("_rs", lambda r: _line_values(r, F.lit("O"))))
        .otherwise(F.transform("_rs", lambda r: _line_values(r))).alias("rows"),
        F.when(is_update, F.transform("_rs", lambda r: _line_values(r))).alias("rows_after"),
        F.lit(DB_NAME).alias("database"),
        F.lit(LINEITEM_TABLE).alias("table"),
    )


def order_row_events(orders: DataFrame) -> DataFrame:
    """Each order as a one-row INSERT event (values = order image as text)."""
    rows = order_rows(orders)
    values = F.array(*[F.col(c).cast("string") for c in rows.columns])
    return rows.select(
        F.col("o_orderkey").alias("position"),
        F.lit("INSERT").alias("event_type"),
        F.lit(2).cast("long").alias("table_id"),
        F.array(values).alias("rows"),
        F.lit(None).cast("array<array<string>>").alias("rows_after"),
        F.lit(DB_NAME).alias("database"),
        F.lit(ORDERS_TABLE).alias("table"),
    )


# ------------------------------------------------------------------ events ---

def event_messages(events: DataFrame, truncate_type: str | None = None, spoil_type: str | None = None) -> DataFrame:
    """``key, value`` insert envelopes of events; messages of ``truncate_type``
    are cut to half their length (broken JSON), those of ``spoil_type`` have, by
    ``event_id`` mod 4, no text, no payload, no time, or a time without a date."""
    after = F.struct(
        F.col("event_id"),
        epoch_millis("ts", ntz=True).alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
    )
    payload = F.struct(F.lit(None).cast(EVENT_ENVELOPE_ROW).alias("before"), after.alias("after"),
                       F.lit("c").alias("op"), epoch_millis("ts", ntz=True).alias("ts_ms"))
    text = F.to_json(F.struct(payload.alias("payload")))
    if truncate_type is not None:
        cut = F.substring(text, F.lit(1), (F.length(text) / 2).cast("int"))
        text = F.when(F.col("event_type") == truncate_type, cut).otherwise(text)
    if spoil_type is not None:
        way = F.col("event_id") % 4
        spoilt = (F.when(way == 1, F.lit('{"payload":null}')).when(way == 2, F.regexp_replace(text, r',"ts_ms":-?\d+', ""))
                  .when(way == 3, F.regexp_replace(text, r'"ts_ms":-?\d+', '"ts_ms":9223372036854775807')))
        text = F.when(F.col("event_type") == spoil_type, spoilt).otherwise(text)
    return events.select(F.col("event_id").cast("string").alias("key"),
                                                       text.alias("value"))


def simple_messages(events: DataFrame) -> DataFrame:
    """``key, value`` (bytes) of simple JSON messages: the props of events, cut
    short for ``error`` events and missing for ``signup`` ones."""
    et = F.col("event_type")
    text = F.when(et == "error", F.expr("left(props, length(props) - 1)")).when(et == "signup", F.lit(None)).otherwise(F.col("props"))
    return events.select(F.col("event_id").cast("string").alias("key"), text.cast("binary").alias("value"))


def event_maps_and_rows(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table-map records, row events) of the events table."""
    is_map = F.col("event_type") == "error"
    maps = events.filter(is_map).select(
        F.col("event_id").alias("position"),
        F.col("user_id").alias("table_id"),
        F.concat(F.lit("db_"), F.col("user_id").cast("string")).alias("database"),
        F.concat(F.lit("t_"), F.col("event_id").cast("string")).alias("table"),
    )
    rows = events.filter(~is_map | F.col("event_type").isNull()).select(
        F.col("event_id").alias("position"), F.col("user_id").alias("table_id")
    )
    return maps, rows


def event_landed_records(events: DataFrame) -> DataFrame:
    """Events as landed binlog records: TABLE_MAP for ``error``, INSERT otherwise."""
    is_map = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("position"),
        F.when(is_map, F.lit("TABLE_MAP")).otherwise(F.lit("INSERT")).alias("event_type"),
        F.col("user_id").alias("table_id"),
        F.when(~is_map, F.array(F.array(F.col("event_id").cast("string")))).alias("rows"),
        F.lit(None).cast("array<array<string>>").alias("rows_after"),
        F.when(is_map, F.concat(F.lit("db_"), F.col("user_id").cast("string"))).alias("database"),
        F.when(is_map, F.concat(F.lit("t_"), F.col("event_id").cast("string"))).alias("table"),
    )


def raw_event_feed(events: DataFrame) -> DataFrame:
    """Events as raw listener output, including placeholder and ignored kinds:
    purchase -> INSERT, click -> UPDATE (value + 1 after), signup -> DELETE,
    view -> NO_EVENT, error -> ROTATE."""
    et = F.col("event_type")
    kind = (
        F.when(et == "purchase", F.lit("INSERT"))
        .when(et == "click", F.lit("UPDATE"))
        .when(et == "signup", F.lit("DELETE"))
        .when(et == "view", F.lit("NO_EVENT"))
        .otherwise(F.lit("ROTATE"))
    )
    row = F.array(F.col("event_id").cast("string"), money("value").cast("string"), F.col("props"))
    row_after = F.array(F.col("event_id").cast("string"), money(F.col("value") + 1).cast("string"), F.col("props"))
    return events.select(
        F.col("event_id").alias("position"),
        kind.alias("event_type"),
        F.col("user_id").alias("table_id"),
        F.array(row).alias("rows"),
        F.when(kind == "UPDATE", F.array(row_after)).alias("rows_after"),
    )


def event_change_forms(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as changes of records in the three forms (decoded envelopes, publish records, row-event messages), by
    event_id mod 5.  The record is the user, but ``hot`` for every third event; the operation goes through insert,
    two updates and a delete by event_id div 2, whatever came before, and the time is event_id seconds."""
    record = F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
    turn = F.expr("(event_id div 2) % 4")
    op = F.when(turn == 0, F.lit("I")).when(turn == 3, F.lit("D")).otherwise(F.lit("U"))
    rows = events.select("event_id", record.alias("k"), op.alias("op"), (F.col("event_id") % 5).alias("form"))

    def image(side: str):
        return F.struct(F.col("k"), F.concat(F.lit(side), F.col("event_id").cast("string")).alias("v"))

    before = F.when(F.col("op") != "I", image("b"))
    after = F.when(F.col("op") != "D", image("a"))
    letter = F.when(F.col("op") == "I", F.lit("c")).when(F.col("op") == "U", F.lit("u")).otherwise(F.lit("d"))
    envelopes = rows.where("form < 2").select(before.alias("before"), after.alias("after"), letter.alias("op"),
                                              (F.col("event_id") * 1000).alias("ts_ms"))
    published = rows.where("form in (2, 3)").select(
        F.lit(DB_NAME).alias("db_name"), F.lit("records").alias("table_name"), F.col("k").alias("record_id"), F.col("op").alias("operation"),
        F.to_json(after).alias("new_data"), F.col("event_id").alias("timestamp_epoch"))
    event = F.when(F.col("op") == "I", F.lit("INSERT")).when(F.col("op") == "U", F.lit("UPDATE")).otherwise(F.lit("DELETE"))

    def values(side: str):
        return F.array(F.col("k"), F.concat(F.lit(side), F.col("event_id").cast("string")))

    row_events = rows.where("form = 4").select(
        event.alias("event"), F.lit(DB_NAME).alias("database"), F.lit("records").alias("table"),
        F.when(F.col("op") == "I", values("a")).when(F.col("op") == "D", values("b")).alias("values"),
        F.when(F.col("op") == "U", values("b")).alias("before"), F.when(F.col("op") == "U", values("a")).alias("after"),
        (F.col("event_id") * 1000).alias("at_ms"))
    return envelopes, published, row_events


def event_offsets(events: DataFrame) -> DataFrame:
    """Events as records of a topic of three partitions (event_id mod 3), offset event_id div 3: offsets 500 to 504
    of every thousand never landed, those with offset mod 777 below 3 landed twice."""
    rows = events.select(F.lit("t").alias("topic"), F.expr("event_id % 3").cast("int").alias("partition"), F.expr("event_id div 3").alias("offset"))
    landed = rows.where("offset % 1000 not between 500 and 504")
    return landed.unionByName(landed.where("offset % 777 < 3"))
