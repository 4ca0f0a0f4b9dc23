"""One common changelog from the three message forms.

Output columns: ``form, db, table_name, record_key, op (I/U/D), before,
after, ts_ms`` -- ``before``/``after`` as JSON text so the forms union.
Consumers order by ``ts_ms`` (and a source position), never by arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHANGELOG_COLUMNS = ("form", "db", "table_name", "record_key", "op", "before", "after", "ts_ms")

# Envelope op letters -> audit operation codes.
ENVELOPE_OPS = {"c": "I", "r": "I", "u": "U", "d": "D"}
ROW_EVENT_OPS = {"INSERT": "I", "UPDATE": "U", "DELETE": "D"}


def _map_op(col: str, mapping: dict[str, str]):
    expr = None
    for src, dst in mapping.items():
        expr = (F.when(F.col(col) == src, F.lit(dst)) if expr is None
                else expr.when(F.col(col) == src, F.lit(dst)))
    return expr


def from_envelope(decoded: DataFrame, db: str, table: str, key_field: str) -> DataFrame:
    """Decoded before/after envelopes (``before, after, op, ts_ms``)."""
    return decoded.select(
        F.lit("envelope").alias("form"),
        F.lit(db).alias("db"),
        F.lit(table).alias("table_name"),
        F.coalesce(F.col(f"after.{key_field}"), F.col(f"before.{key_field}")).cast("string").alias("record_key"),
        _map_op("op", ENVELOPE_OPS).alias("op"),
        F.when(F.col("before").isNotNull(), F.to_json("before")).alias("before"),
        F.when(F.col("after").isNotNull(), F.to_json("after")).alias("after"),
        F.col("ts_ms"),
    )


def from_publish(records: DataFrame) -> DataFrame:
    """Publish messages (the eleven fields, parsed)."""
    return records.select(
        F.lit("publish").alias("form"),
        F.col("db_name").alias("db"),
        F.col("table_name"),
        F.col("record_id").alias("record_key"),
        F.col("operation").alias("op"),
        F.lit(None).cast("string").alias("before"),
        F.col("new_data").alias("after"),
        (F.col("timestamp_epoch") * 1000).alias("ts_ms"),
    )


def from_row_events(messages: DataFrame, key_index: int = 1, ts_ms: str | None = None) -> DataFrame:
    """Parsed row-event messages (``event, database, table, values/before/after``).

    ``record_key`` is the value at position ``key_index`` (1-based); ``ts_ms`` names
    a column with the event's time, if the messages carry one.
    """
    is_upd = F.col("event") == "UPDATE"
    key_arr = F.when(is_upd, F.col("after")).otherwise(F.col("values"))
    return messages.select(
        F.lit("row_event").alias("form"),
        F.col("database").alias("db"),
        F.col("table").alias("table_name"),
        F.element_at(key_arr, key_index).alias("record_key"),
        _map_op("event", ROW_EVENT_OPS).alias("op"),
        F.when(is_upd, F.to_json("before"))
        .when(F.col("event") == "DELETE", F.to_json("values")).alias("before"),
        F.when(is_upd, F.to_json("after"))
        .when(F.col("event") == "INSERT", F.to_json("values")).alias("after"),
        (F.col(ts_ms) if ts_ms else F.lit(None)).cast("long").alias("ts_ms"),
    )


def to_changelog(*parts: DataFrame) -> DataFrame:
    """Union of already-normalised parts (``from_*`` outputs) by name."""
    out = parts[0].select(*CHANGELOG_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*CHANGELOG_COLUMNS), allowMissingColumns=True)
    return out
