"""SHA-256 identity, version and content keys of a change record.

The three keys are plain string concatenations hashed with SHA-256 (lower
case hex over UTF-8), which ``sha2(..., 256)`` computes JVM-side:

* ``hash_id``     = H(db_type + db_name + table_name + record_id)
* ``hash_pk``     = H(db_type + db_name + table_name + record_id + epoch_seconds)
* ``hash_record`` = H(new_data)

A null part is rendered as the text ``null`` (what string concatenation on
the producer side does), so the keys never collapse to NULL.  ``sep`` is
empty by default for compatibility; pass e.g. ``"|"`` to rule out
"a"+"bc" == "ab"+"c" collisions in new data sets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha256_hex(c: ColumnOrName) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text of ``c`` (NULL stays NULL)."""
    return F.sha2(_col(c).cast("string"), 256)


def null_as_text(c: ColumnOrName) -> Column:
    """Text of ``c``, with NULL rendered as ``'null'``."""
    return F.coalesce(_col(c).cast("string"), F.lit("null"))


def _joined(parts: list[ColumnOrName], sep: str) -> Column:
    texts = [null_as_text(p) for p in parts]
    return F.concat_ws(sep, *texts) if sep else F.concat(*texts)


def hash_id(db_type: ColumnOrName, db_name: ColumnOrName, table_name: ColumnOrName,
            record_id: ColumnOrName, sep: str = "") -> Column:
    """Identity key of a record: same for every version of it."""
    return F.sha2(_joined([db_type, db_name, table_name, record_id], sep), 256)


def hash_pk(db_type: ColumnOrName, db_name: ColumnOrName, table_name: ColumnOrName,
            record_id: ColumnOrName, epoch_seconds: ColumnOrName, sep: str = "") -> Column:
    """Version key: identity plus whole epoch seconds of the change.

    Two changes of one record within the same second share it, so never
    deduplicate on this key alone.
    """
    return F.sha2(_joined([db_type, db_name, table_name, record_id, epoch_seconds], sep), 256)


def hash_record(new_data: ColumnOrName) -> Column:
    """Content key: hash of the new row image text; NULL for deletes."""
    return sha256_hex(new_data)


def packed_id(col: Column) -> Column:
    """A text id as bytes, half as long where it is a SHA-256 in lowercase hex; different ids stay different."""
    text = col.cast("string")
    return F.when(text.rlike("^[0-9a-f]{64}\\z"), F.concat(F.lit(bytearray([1])), F.unhex(text))).otherwise(
        F.concat(F.lit(bytearray([0])), text.cast("binary")))


def unpacked_id(col: Column) -> Column:
    """The text of :func:`packed_id`."""
    rest = F.substring(col, 2, 2147483647)
    return F.when(F.substring(col, 1, 1) == F.lit(bytearray([1])), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
