"""Audit capture and publishing: the trigger + poller half of the pipeline.

* :func:`capture_changes` turns two versions of a table into one audit row
  per inserted, updated or deleted record (what row triggers write).
* :func:`publish_records` / :func:`publish_envelope` turn audit rows into the
  eleven-field publish message with its SHA-256 keys.
* :func:`pending`, :func:`unpublished` select rows not yet published.
* :func:`check_key` lists rows that break a primary-key requirement.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.hashing import hash_id, hash_pk, hash_record, packed_id, unpacked_id
from changelake.functions.jsoncols import row_json
from changelake.functions.timecols import date_text, epoch_millis, epoch_seconds

# Fixed values of the publish side (defaults of the producer configuration).
DEFAULT_DB_TYPE = "POSTGRESQL"
DEFAULT_TOPIC_PREFIX = "kfk_stream_"
DEFAULT_CONTROL_COLUMN = "is_in_kafka"

PUBLISH_FIELDS = (
    "db_type", "db_name", "table_name", "record_id", "new_data", "hash_id",
    "hash_pk", "hash_record", "operation", "timestamp_epoch", "data",
)


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def op_code(old_present: Column, new_present: Column) -> Column:
    """I when only the new row exists, D when only the old one, else U."""
    return F.when(~old_present, F.lit("I")).when(~new_present, F.lit("D")).otherwise(F.lit("U"))


def record_id(keys: Sequence[str]) -> Column:
    """Key as text: one column cast to string; a composite key as a JSON array of
    its parts' texts, so no two keys share an id."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))


def _image_json(side: str, cols: Sequence[str]) -> Column:
    return row_json([F.col(f"{side}.{c}").alias(c) for c in cols])


def _unique_row(df: DataFrame, keys: Sequence[str], label: str) -> Column:
    """The row as a struct; evaluating it fails where the key is NULL or was met before."""
    same_key = Window.partitionBy(*keys).orderBy(*keys)
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    broken = F.raise_error(F.concat(F.lit(f"{label}: key {keys} is not a primary key (null or repeated): "), row_json(keys)))
    return F.when(null_key | (F.row_number().over(same_key) > 1), broken).otherwise(F.struct(*[F.col(c) for c in df.columns]))


def capture_changes(old: DataFrame, new: DataFrame, key: str | Sequence[str],
                    cols: Sequence[str] | None = None, db_name: str = "db",
                    table_name: str = "table", captured_at: Column | None = None,
                    version: str | None = None, validate_key: bool = True) -> DataFrame:
    """Audit rows for the difference between two versions of a table.

    * key only in ``new`` -> ``I`` with ``new_data`` only;
    * key only in ``old`` -> ``D`` with ``old_data`` only;
    * in both with any column different (null-safe) -> ``U`` with both.

    ``old_data``/``new_data`` are JSON objects of ``cols`` (all columns when
    None, keys as typed, nulls kept).  A change outside ``cols`` still yields
    a ``U`` row, as a row trigger fires on any update.  Updates that change
    nothing, and intermediate versions between the two snapshots, are not
    visible from two snapshots.

    ``audit_log_id`` is deterministic (SHA-256 of db, table, record id,
    operation and ``version``) so a retried job writes the same ids.
    ``version`` names this capture and must differ from that of any other
    capture of the table; without it ``captured_at`` is used, and one of the
    two must be given, else two updates of a record would share an id.

    Columns added or dropped between the versions show as ``U`` rows of
    every record in both; each image has the columns of its own version.

    Plan: one full outer join on the key (both sides shuffled by key, or
    none when both are bucketed by it); JSON text is built after the
    join, only for changed rows.

    The key must be unique in each version: a duplicated key would make
    the join emit every old x new pair of that key.  ``validate_key``
    (default) makes the job fail on the first NULL or repeated key instead.
    The check numbers the rows of a key within the partitioning and order
    that the join needs anyway, so it reads and shuffles nothing more.
    """
    keys = _keys(key)
    if not version and captured_at is None:
        raise ValueError("capture_changes needs a version or captured_at: it identifies the capture")
    all_cols = [c for c in new.columns if c not in keys]
    old_cols = [c for c in cols if c in old.columns] if cols else list(old.columns)
    new_cols = [c for c in cols if c in new.columns] if cols else list(new.columns)
    row = _unique_row if validate_key else (lambda df, *_: F.struct(*[F.col(c) for c in df.columns]))
    o = old.select(*keys, row(old, keys, "old").alias("_o"))
    n = new.select(*keys, row(new, keys, "new").alias("_n"))
    joined = o.join(n, keys, "full_outer")
    old_in, new_in = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    same = F.lit(False) if set(old.columns) != set(new.columns) else F.struct(*[F.col(f"_o.{c}") for c in all_cols]).eqNullSafe(
        F.struct(*[F.col(f"_n.{c}") for c in all_cols])
    )
    changed = joined.filter(~old_in | ~new_in | ~same)
    op = op_code(old_in, new_in)
    ts = captured_at if captured_at is not None else F.current_timestamp()
    out = changed.select(
        record_id(keys).alias("record_id"),
        op.alias("operation"),
        F.when(old_in, _image_json("_o", old_cols)).alias("old_data"),
        F.when(new_in, _image_json("_n", new_cols)).alias("new_data"),
    )
    return out.select(
        F.sha2(
            F.concat_ws("|", F.lit(db_name), F.lit(table_name), F.col("record_id"),
                        F.col("operation"), F.lit(version) if version else ts.cast("string")),
            256,
        ).alias("audit_log_id"),
        F.lit(db_name).alias("db_name"),
        F.lit(table_name).alias("table_name"),
        "record_id",
        "operation",
        "old_data",
        "new_data",
        ts.cast("timestamp").alias("timestamp"),
        F.lit(False).alias(DEFAULT_CONTROL_COLUMN),
    )


def pending(df: DataFrame, control: str = DEFAULT_CONTROL_COLUMN) -> DataFrame:
    """Rows whose control flag is exactly false (NULL is not pending).

    Reaches a Parquet/JDBC scan as a pushed filter.
    """
    return df.filter(F.col(control) == F.lit(False))


def unpublished(audit: DataFrame, ledger: DataFrame, id_col: str = "audit_log_id") -> DataFrame:
    """Audit rows whose id is not in the acknowledgement ledger (anti-join on packed ids, which both sides shuffle)."""
    if not isinstance(audit.schema[id_col].dataType, T.StringType):
        return audit.join(ledger.select(id_col), id_col, "left_anti")
    known = ledger.select(packed_id(F.col(id_col)).alias(id_col))
    left = audit.withColumn(id_col, packed_id(F.col(id_col))).join(known, id_col, "left_anti")
    return left.withColumn(id_col, unpacked_id(F.col(id_col)))


def publish_source(audit: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """The columns of audit rows that :func:`publish_envelope` reads."""
    return audit.select("audit_log_id", "db_name", "table_name", "record_id", "new_data", "operation", ts_col)


def check_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their count.

    A grouped count with map-side partial aggregation: a hot key is
    collapsed in each task before the shuffle.
    """
    keys = _keys(key)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(any_null | (F.col("n") > 1)).withColumn(
        "violation", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate_key"))
    )


def require_unique_key(df: DataFrame, key: str | Sequence[str], label: str = "table") -> None:
    """Raise ``ValueError`` when ``key`` is NULL or repeated in ``df``.

    Runs one aggregation over the key columns alone (map-side partial
    counts, then a shuffle of keys); reports at most five offenders.
    """
    keys = _keys(key)
    bad = check_key(df.select(*keys), keys).limit(5).collect()
    if bad:
        sample = ", ".join(f"{tuple(r[k] for k in keys)} x{r['n']}" for r in bad)
        raise ValueError(f"{label}: key {keys} is not a primary key (null or repeated): {sample}")


def topic_name(table: str | Column, prefix: str = DEFAULT_TOPIC_PREFIX) -> Column:
    """``prefix + table`` as a column, so one job serves many tables."""
    t = F.lit(table) if isinstance(table, str) else table
    return F.concat(F.lit(prefix), t)


def with_source(df: DataFrame, db_type: str, db_name: str | None = None,
                table_name: str | None = None) -> DataFrame:
    """Constant enrichment columns (kept from the data when given as None)."""
    cols = {"db_type": F.lit(db_type)}
    if db_name is not None:
        cols["db_name"] = F.lit(db_name)
    if table_name is not None:
        cols["table_name"] = F.lit(table_name)
    return df.withColumns(cols)


def publish_records(audit: DataFrame, db_type: str = DEFAULT_DB_TYPE, tz: str = "UTC",
                    ts_col: str = "timestamp", ts_is_ntz: bool | None = None) -> DataFrame:
    """Audit rows -> the eleven publish fields (+ ``audit_log_id``).

    ``hash_record`` of a delete (NULL ``new_data``) is NULL; the row is
    still published.  ``data`` is the audit date in zone ``tz``.

    ``hash_record`` hashes the ``new_data`` text as received: a database
    that re-orders or re-spaces JSON keys produces a different text for the
    same row, so compare content keys only between rows of one producer.

    ``ts_is_ntz`` defaults to the column's type: a TIMESTAMP_NTZ change time
    is read as UTC wall clock.
    """
    if ts_is_ntz is None:
        ts_is_ntz = isinstance(audit.schema[ts_col].dataType, T.TimestampNTZType)
    secs = epoch_seconds(ts_col, ntz=ts_is_ntz)
    millis = epoch_millis(ts_col, ntz=ts_is_ntz)
    src = with_source(audit, db_type)
    return src.select(
        "audit_log_id",
        "db_type",
        "db_name",
        "table_name",
        "record_id",
        "new_data",
        hash_id("db_type", "db_name", "table_name", "record_id").alias("hash_id"),
        hash_pk("db_type", "db_name", "table_name", "record_id", secs).alias("hash_pk"),
        hash_record("new_data").alias("hash_record"),
        "operation",
        secs.alias("timestamp_epoch"),
        date_text(millis, tz).alias("data"),
    )


def publish_envelope(audit: DataFrame, db_type: str = DEFAULT_DB_TYPE, tz: str = "UTC",
                     prefix: str = DEFAULT_TOPIC_PREFIX, ts_col: str = "timestamp",
                     ts_is_ntz: bool | None = None) -> DataFrame:
    """Audit rows -> ``(audit_log_id, key, value, topic)`` topic records.

    ``key`` is the record id (order holds per record), ``value`` the JSON
    object of the eleven fields, ``topic`` = prefix + table name.
    """
    rec = publish_records(audit, db_type, tz, ts_col, ts_is_ntz)
    return rec.select(
        "audit_log_id",
        F.col("record_id").alias("key"),
        row_json(PUBLISH_FIELDS).alias("value"),
        topic_name(F.col("table_name"), prefix).alias("topic"),
    )
