"""JSON text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

KEEP_NULLS = {"ignoreNullFields": "false"}


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_json(cols: Sequence[ColumnOrName] | None = None, keep_nulls: bool = True) -> Column:
    """JSON object of the given columns (keys = column names, in order);
    all columns when ``cols`` is None.  Nulls are kept as ``null`` by default.
    """
    inner = F.struct(*[_col(c) for c in cols]) if cols else F.struct(F.col("*"))
    return F.to_json(inner, KEEP_NULLS) if keep_nulls else F.to_json(inner)


def values_text(values: ColumnOrName, raw: bool = False) -> Column:
    """Array of values as text: JSON (``["a","b"]``) or raw (``[a,b]``)."""
    arr = _col(values)
    if raw:
        return F.concat(F.lit("["), F.array_join(arr, ",", "null"), F.lit("]"))
    return F.to_json(arr)


def json_field(message: ColumnOrName, name: str, dtype: str = "string", strict: bool = False) -> Column:
    """One top-level field of a JSON text message.

    Missing field or unparsable value gives NULL; ``strict=True`` fails the
    query on either instead (a NULL message stays NULL).
    """
    if "'" in name:
        raise ValueError(f"field names with a quote cannot be addressed: {name!r}")
    raw = F.get_json_object(_col(message), f"$['{name}']")
    if strict:
        lost = F.raise_error(F.concat(F.lit(f"no field {name!r} in "), F.substring(_col(message), 1, 200)))
        raw = F.when(_col(message).isNull(), F.lit(None)).when(raw.isNull(), lost).otherwise(raw)
    if dtype == "string":
        return raw
    return raw.cast(dtype) if strict else raw.try_cast(dtype)


def with_default(c: ColumnOrName, default: str) -> Column:
    """``c`` or a constant when a lookup missed."""
    return F.coalesce(_col(c), F.lit(default))


def money(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Fixed-point money value (exact text and JSON rendering)."""
    return _col(c).cast(f"decimal({precision},{scale})")


def as_variant(text: ColumnOrName) -> Column:
    """JSON text -> VARIANT (NULL when unparsable), for path access with
    ``variant_get`` without fixing a schema up front."""
    return F.try_parse_json(_col(text))
