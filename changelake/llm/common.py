"""Helpers shared by the operators: tables, written intermediates, folds, row slices."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.session import scratch_path

# Rows turned into Python objects at a time inside a task.
SLICE_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the
    stages before the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``(doc, position)``: each row as a struct and its place from 0 in the table as written, by the
    files' part numbers and the rows' places in them.  A read back packs files by size, so the order of
    the rows read says nothing.  What is not a table of files is written first, in the order of its rows.
    """
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():  # noqa: SLF001
        docs = materialize(docs, name)
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta)
    except AnalysisException:
        docs = materialize(docs, name)
        meta = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"),
                       meta["file_path"].alias("file"), meta["row_index"].alias("row"))
    place = [F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).try_cast("long"),
             F.regexp_extract("file", r"-c(\d+)[^/]*$", 1).try_cast("long"), F.col("file")]
    # one row per file
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("file").agg(F.count("*").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "file").select("doc", (F.col("start") + F.col("row")).alias("position"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once a session.

    A job started with ``--py-files`` has them already; a notebook or test
    session does not.  ``addPyFile`` serves the archive from the driver.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="changelake-code-"), "changelake_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("changelake", os.path.relpath(path, top)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 4 is 2 (NULL id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learnable(doc_id: str = "doc_id") -> Column:
    """True where a row may be learned from (a NULL id never is)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
