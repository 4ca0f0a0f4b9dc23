"""Row-log events: classify, explode to one message per row, table-map lookup.

Input is a DataFrame of landed events (see ``sources.files.read_row_events``)
with at least ``position, event_type, table_id, rows`` and, for UPDATE,
``rows_after``.  TABLE_MAP records carry ``database, table``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.jsoncols import values_text, with_default
from changelake.operators.audit import require_unique_key
from changelake.functions.timecols import processing_time
from changelake.operators.joins import asof_lookup, checked_broadcast

# Event kinds and lookup defaults of the row-log listener.
ROW_KINDS = ("INSERT", "UPDATE", "DELETE")
IGNORED_KINDS = ("ROTATE", "FORMAT_DESCRIPTION")
MAP_KIND = "TABLE_MAP"
NO_EVENT = "NO_EVENT"
UNKNOWN_DB = "unknown_db"
UNKNOWN_TABLE = "unknown_table"


def classify_row_events(df: DataFrame, type_col: str = "event_type") -> DataFrame:
    """Add ``kind``: row / map / ignored / unhandled."""
    t = F.col(type_col)
    kind = (
        F.when(t.isin(*ROW_KINDS), F.lit("row"))
        .when(t == MAP_KIND, F.lit("map"))
        .when(t.isin(*IGNORED_KINDS), F.lit("ignored"))
        .otherwise(F.lit("unhandled"))
    )
    return df.withColumn("kind", kind)


def row_events_only(df: DataFrame, type_col: str = "event_type") -> DataFrame:
    """Keep INSERT/UPDATE/DELETE events."""
    return df.filter(F.col(type_col).isin(*ROW_KINDS))


def drop_no_event(df: DataFrame, type_col: str = "event_type") -> DataFrame:
    """Drop placeholder ``NO_EVENT`` rows."""
    return df.filter(F.col(type_col) != F.lit(NO_EVENT))


def raw_stream_form(df: DataFrame, with_time: bool = True) -> DataFrame:
    """``event_type, table_id, rows`` (all rows of the event as one JSON text)
    and ``event_time`` (processing time) of row events."""
    rows = F.when(
        F.col("event_type") == "UPDATE",
        F.to_json(F.arrays_zip(F.col("rows").alias("before"), F.col("rows_after").alias("after"))),
    ).otherwise(F.to_json(F.col("rows")))
    cols = [F.col("event_type"), F.col("table_id"), rows.alias("rows")]
    if with_time:
        cols.append(processing_time().alias("event_time"))
    return row_events_only(df).select(*cols)


def incomplete_updates(df: DataFrame) -> DataFrame:
    """UPDATE events whose before- and after-images do not pair up."""
    unpaired = F.col("rows").isNull() | F.col("rows_after").isNull() | (F.size("rows") != F.size("rows_after"))
    return df.filter((F.col("event_type") == "UPDATE") & unpaired)


def explode_rows(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One output row per row of an event: ``row_index``, ``values`` for
    INSERT/DELETE, ``before``/``after`` for UPDATE.

    An UPDATE without its after-image, or with fewer after- than before-rows,
    keeps every row; the missing side is NULL (``incomplete_updates`` lists them).
    """
    is_update = F.col("event_type") == "UPDATE"
    no_rows = F.slice(F.col("rows"), 1, 0)
    after = F.coalesce(F.col("rows_after"), no_rows)
    before = F.coalesce(F.col("rows"), F.slice(F.col("rows_after"), 1, 0))
    pairs = F.when(
        is_update, F.arrays_zip(before.alias("b"), after.alias("a"))
    ).otherwise(F.arrays_zip(F.col("rows").alias("b"), F.col("rows").alias("a")))
    exploded = df.select(
        *keep, "position", "event_type", "table_id", "database", "table",
        F.posexplode(pairs).alias("row_index", "_pair"),
    )
    upd = F.col("event_type") == "UPDATE"
    return exploded.select(
        *keep, "position", "event_type", "table_id", "database", "table", "row_index",
        F.when(~upd, F.col("_pair.b")).alias("values"),
        F.when(upd, F.col("_pair.b")).alias("before"),
        F.when(upd, F.col("_pair.a")).alias("after"),
    )


def row_event_json(df: DataFrame, raw: bool = False) -> Column:
    """Message text of an exploded row: ``{event, database, table, values}``
    or ``{event, database, table, before, after}``.

    Default is valid JSON (values quoted, nulls kept inside arrays).
    Field names and order are fixed values, the listener's message format.
    ``raw=True`` renders the arrays unquoted, as the listener's text does; a
    NULL database or table shows as ``null`` there.
    """
    if not raw:
        return F.to_json(
            F.struct(
                F.col("event_type").alias("event"),
                F.col("database"),
                F.col("table"),
                F.col("values"),
                F.col("before"),
                F.col("after"),
            )
        )
    head = F.concat(
        F.lit('{"event":"'), F.col("event_type"), F.lit('","database":"'), with_default("database", "null"),
        F.lit('","table":"'), with_default("table", "null"), F.lit('",'),
    )
    body = F.when(
        F.col("event_type") == "UPDATE",
        F.concat(F.lit('"before":'), values_text("before", raw=True), F.lit(',"after":'),
                 values_text("after", raw=True)),
    ).otherwise(F.concat(F.lit('"values":'), values_text("values", raw=True)))
    return F.concat(head, body, F.lit("}"))


def lookup_table_map(events: DataFrame, maps: DataFrame, key: str = "table_id",
                     pos: str = "position", bucket_width: int = 1 << 20, levels: int = 1) -> DataFrame:
    """Attach ``database, table`` of the latest table-map record seen at or
    before each event (same table id), else ``unknown_db/unknown_table``.

    Skew-safe as-of (see :func:`changelake.operators.joins.asof_lookup`).
    """
    looked = asof_lookup(events, maps, key, pos, ["database", "table"], bucket_width, levels)
    return looked.withColumn("database", with_default("database", UNKNOWN_DB)).withColumn(
        "table", with_default("table", UNKNOWN_TABLE)
    )


def lookup_table_map_static(events: DataFrame, maps: DataFrame, key: str = "table_id") -> DataFrame:
    """Table map known up front (one row per id): left join, defaults on miss.

    The map must hold one row per id (checked; a repeated id would pair each
    event with several map rows).  It is broadcast only when its measured
    size is within bounds.
    """
    m = maps.select(key, "database", "table")
    require_unique_key(m, key, "table map")
    m = checked_broadcast(m)
    out = events.join(m, key, "left")
    return out.withColumn("database", with_default("database", UNKNOWN_DB)).withColumn(
        "table", with_default("table", UNKNOWN_TABLE)
    )
