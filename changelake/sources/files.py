"""File-based sources: landed row events and the date-partitioned lake."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.schemas import ROW_EVENT, TABLE_MAP

LANDED_EVENT = T.StructType(
    ROW_EVENT.fields + [f for f in TABLE_MAP.fields if f.name in ("database", "table")]
)


def read_row_events(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
                    max_files_per_trigger: int | None = None,
                    schema: T.StructType = LANDED_EVENT) -> DataFrame:
    """Row-log events already landed as files (JSON lines or Parquet).

    Streaming reads are replayable (file offsets live in the checkpoint);
    ``max_files_per_trigger`` bounds each micro-batch.
    """
    if stream:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.schema(schema).format(fmt).load(path)


def _as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def read_lake(spark: SparkSession, path: str, start: dt.date | str | None = None,
              end: dt.date | str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Read the lake; ``start``/``end`` (inclusive) become partition filters
    on ``year/month/day``, so only files of matching folders are read (all folders are listed)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    day = F.make_date("year", "month", "day")
    if start is not None:
        df = df.filter(day >= F.lit(_as_date(start)))
    if end is not None:
        df = df.filter(day <= F.lit(_as_date(end)))
    return df
