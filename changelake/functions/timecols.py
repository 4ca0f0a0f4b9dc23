"""Time helpers with explicit zones.

Date parts and date text are computed on TIMESTAMP_NTZ wall clocks with an
explicit zone (``convert_timezone``), so results do not depend on the
session time zone of whoever runs the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_from_millis(millis: ColumnOrName) -> Column:
    """Epoch milliseconds -> UTC wall clock as TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _col(millis), F.expr(_EPOCH_NTZ))


_UNITS = {"s": "SECOND", "ms": "MILLISECOND", "us": "MICROSECOND"}


def ntz_from_epoch(value: ColumnOrName, unit: str = "ms") -> Column:
    """Epoch number in ``unit`` (``s``, ``ms``, ``us``) -> UTC wall clock (TIMESTAMP_NTZ).

    The envelope's ``timestamp`` field is a long whose unit the producer
    does not state; it is kept raw unless the caller names the unit.
    """
    return F.timestamp_add(_UNITS[unit], _col(value), F.expr(_EPOCH_NTZ))


def epoch_millis(ts: ColumnOrName, ntz: bool = False) -> Column:
    """Epoch milliseconds of a timestamp; an NTZ value is read as UTC wall clock."""
    if ntz:
        return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _col(ts))
    return F.unix_millis(_col(ts))


def epoch_seconds(ts: ColumnOrName, ntz: bool = False) -> Column:
    """Whole epoch seconds, millis divided with truncation toward zero.

    1969-12-31 23:59:58.5 gives -1 (not the floor, -2).
    """
    ms = epoch_millis(ts, ntz)
    # Java remainder keeps the dividend's sign, so this truncates toward zero.
    return ((ms - ms % 1000) / 1000).cast("long")


def wall_clock(millis: ColumnOrName, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> local wall clock in ``tz`` (TIMESTAMP_NTZ)."""
    utc = ntz_from_millis(millis)
    if tz.upper() in ("UTC", "Z", "ETC/UTC", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def date_text(millis: ColumnOrName, tz: str = "UTC", fmt: str = "yyyy-MM-dd") -> Column:
    """Formatted local date of epoch milliseconds in ``tz``."""
    return F.date_format(wall_clock(millis, tz), fmt)


def seconds_text(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text (fraction dropped)."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def date_parts(millis: ColumnOrName, tz: str = "UTC") -> dict[str, Column]:
    """``{'year', 'month', 'day'}`` of epoch milliseconds in ``tz`` (INT)."""
    local = wall_clock(millis, tz)
    return {"year": F.year(local), "month": F.month(local), "day": F.dayofmonth(local)}


def processing_time() -> Column:
    """Processing-time stamp: one value per (micro-)batch."""
    return F.current_timestamp()
