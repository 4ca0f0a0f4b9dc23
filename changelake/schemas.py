"""StructTypes of the change records the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values, the wire format: source table `transactions` as a before/after envelope carries it: the
# time is epoch-based long and the amount is text.
TRANSACTION_ROW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("amount", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("affiliateid", T.StringType()),
    ]
)

# Fixed value: the DDL spells the column affiliateId while the lake schema
# reads affiliateid; JSON keys are case-sensitive, so both are accepted.
TRANSACTION_ALIASES = {"affiliateid": ["affiliateId"]}

CORRUPT_COLUMN = "_corrupt_record"


def envelope_schema(row: T.StructType, with_corrupt: bool = True) -> T.StructType:
    """``{payload: {before: row, after: row, op, ts_ms}}``."""
    payload = T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    fields = [T.StructField("payload", payload)]
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType()))
    return T.StructType(fields)


# Audit log row written for each captured change.
AUDIT = T.StructType(
    [
        T.StructField("audit_log_id", T.StringType(), False),
        T.StructField("db_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("old_data", T.StringType()),
        T.StructField("new_data", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("is_in_kafka", T.BooleanType()),
    ]
)

# Eleven-field publish message (value of the topic record).
PUBLISH = T.StructType(
    [
        T.StructField("db_type", T.StringType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("new_data", T.StringType()),
        T.StructField("hash_id", T.StringType()),
        T.StructField("hash_pk", T.StringType()),
        T.StructField("hash_record", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("timestamp_epoch", T.LongType()),
        T.StructField("data", T.StringType()),
    ]
)

# Row-event message: INSERT/DELETE carry `values`, UPDATE `before`/`after`.
ROW_EVENT_MESSAGE = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("values", T.ArrayType(T.StringType())),
        T.StructField("before", T.ArrayType(T.StringType())),
        T.StructField("after", T.ArrayType(T.StringType())),
    ]
)

# Landed row event: one binlog event, many rows.  `rows` holds one array of
# values per row; for UPDATE the pair is (before, after).
ROW_EVENT = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("table_id", T.LongType()),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("rows_after", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

# Table-map record (binlog TABLE_MAP event).
TABLE_MAP = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("table_id", T.LongType()),
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
    ]
)

# Raw stream form: event type, table id, rows rendered as text, processing time.
RAW_ROW_EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("table_id", T.LongType()),
        T.StructField("rows", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# Simple message {"valor": n}.
SIMPLE_MESSAGE = T.StructType([T.StructField("valor", T.IntegerType())])
