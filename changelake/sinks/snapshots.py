"""A lake of snapshots with zone maps and compaction (K1, S7).

Data files lie below ``data/``, clustered by date.  Lists name them with
their size, rows and zone map: for the date and each zone column the least
and greatest value and the number of NULLs.  A manifest names the live lists
and the batches they hold; its number is the snapshot.

* ``append`` writes a batch's files, lists them and commits; a replayed
  batch number adds nothing.
* ``read`` plans from the lists: only files whose zones meet the asked
  ranges are opened, and no data folder is listed.  A reader that holds a
  snapshot number keeps its view while the snapshot is kept.
* ``compact`` rewrites files below ``small_bytes`` (half the target size) to files of about
  the target size, or of ``target_rows`` rows where those are smaller (a task sorts the rows
  of its file), sorted by date and zone column; the swap is one commit,
  so a crash before it changes nothing.
* ``vacuum`` removes what no kept snapshot names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.joins import checked_broadcast
from changelake.sinks.lake import LAKE_PARTITIONS, remove_path
from changelake.sinks.manifest import ManifestConflict, ManifestLog, covered, joined
from changelake.sources.files import _as_date

TARGET_BYTES = 256 << 20
TARGET_ROWS = 1 << 20
DATE = "_date"
# Lists are written to one when there are so many.
MAX_LISTS = 32


def _day(by: Sequence[str]) -> Column:
    """A date as one rising number (NULL if a part is NULL)."""
    return F.col(by[0]).cast("long") * 10_000 + F.col(by[1]).cast("long") * 100 + F.col(by[2]).cast("long")


def _number(day: dt.date | str) -> int:
    d = _as_date(day)
    return d.year * 10_000 + d.month * 100 + d.day


class SnapshotLake:
    """The lake below ``path`` of rows of ``schema``; ``zones`` are further columns with zone maps, the first of them a sort key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, zones: Sequence[str] = (),
                 by: Sequence[str] = LAKE_PARTITIONS, target_bytes: int = TARGET_BYTES, small_bytes: int | None = None,
                 keep: int = 5, target_rows: int = TARGET_ROWS):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.by, self.zones, self.target_bytes = tuple(by), tuple(zones), target_bytes
        self.target_rows = target_rows
        self.small_bytes = target_bytes // 2 if small_bytes is None else small_bytes
        self.log = ManifestLog(spark, f"{self.path}/snapshots", keep)
        kinds = {DATE: T.LongType(), **{z: schema[z].dataType for z in self.zones}}
        self.list_schema = T.StructType().add("file", "string").add("bytes", "long").add("rows", "long")
        for z, kind in kinds.items():
            self.list_schema.add(f"lo_{z}", kind).add(f"hi_{z}", kind).add(f"nulls_{z}", "long")

    # ------------------------------------------------------------ state ---

    def snapshot(self) -> int:
        """The newest snapshot (0: nothing was committed yet)."""
        return self.log.latest()[0]

    def _doc(self, snapshot: int | None) -> dict:
        if snapshot is None:
            return self.log.latest()[1] or {"lists": [], "batches": []}
        return self.log.read(snapshot) if snapshot else {"lists": [], "batches": []}

    def files(self, snapshot: int | None = None) -> DataFrame:
        """The live files with their zones."""
        return self._listed(self._doc(snapshot)["lists"])

    def _listed(self, lists: list[str]) -> DataFrame:
        if not lists:
            return self.spark.createDataFrame([], self.list_schema)
        return self.spark.read.schema(self.list_schema).parquet(*[f"{self.path}/lists/{x}" for x in lists])

    # ---------------------------------------------------------- writing ---

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        """Files of ``df`` below ``data/<name>``, described."""
        at = f"{self.path}/data/{name}"
        df.select(*self.schema.names).write.parquet(at)
        rows = self.spark.read.schema(self.schema).parquet(at)
        # one narrow scan of the zone columns, one row a file
        zones = {DATE: _day(self.by), **{z: F.col(z) for z in self.zones}}
        stats = [f for z, c in zones.items() for f in (F.min(c).alias(f"lo_{z}"), F.max(c).alias(f"hi_{z}"),
                                                       F.sum(c.isNull().cast("long")).alias(f"nulls_{z}"))]
        return rows.groupBy(F.concat(F.lit(f"{name}/"), F.col("_metadata.file_name")).alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("rows"), *stats)

    def _list(self, described: DataFrame) -> str:
        name = uuid.uuid4().hex[:12]
        described.select(*self.list_schema.names).write.parquet(f"{self.path}/lists/{name}")
        return name

    def append(self, df: DataFrame, batch_id: int) -> bool:
        """Add a batch; False if the batch number is in the lake already.

        A rebalance on the date merges small dates and splits a hot one; rows of a task are sorted, so a file spans few dates."""
        if covered(self._doc(None)["batches"], batch_id):
            return False
        rows = df.hint("rebalance", *self.by).sortWithinPartitions(*self.by, *self.zones[:1])
        listed = self._list(self._write(rows, f"b{batch_id}-{uuid.uuid4().hex[:12]}"))
        while True:
            number, doc = self.log.latest()
            doc = doc or {"lists": [], "batches": []}
            if covered(doc["batches"], batch_id):
                raise ManifestConflict(f"{self.path}: another writer added batch {batch_id}")
            lists = [*doc["lists"], listed]
            if len(lists) > MAX_LISTS:
                lists = [self._list(self._listed(lists).coalesce(1))]
            try:
                self.log.commit(number, {"lists": lists, "batches": joined([*doc["batches"], [batch_id, batch_id]])})
                return True
            except ManifestConflict:
                continue

    def compact(self, before_commit: Callable[[], None] | None = None) -> int:
        """Rewrite small files; how many were replaced.  May run beside appends and readers.

        ``before_commit`` runs between the writing of files and the swap (for tests of a crash there)."""
        start = self._doc(None)["lists"]
        small = self._listed(start).where((F.col("bytes") < self.small_bytes) & (F.col("rows") < self.target_rows // 2))
        n, size, n_rows = small.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("rows")).first()
        if n < 2:
            return 0
        names = [r["file"] for r in small.select("file").collect()]  # one name a small file
        # sorted runs of about the target size: neighbouring dates share a file, a hot date has several
        parts = max(1, -(-size // self.target_bytes), -(-n_rows // self.target_rows))
        order = [*self.by, *self.zones[:1]]
        rows = self._open(names).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        added = self._list(self._write(rows, f"c-{uuid.uuid4().hex[:12]}"))
        if before_commit:
            before_commit()
        gone = checked_broadcast(self.spark.createDataFrame([(x,) for x in names], "file string"))
        while True:
            number, doc = self.log.latest()
            if not set(start) <= set(doc["lists"]):
                return 0  # another compaction swapped them; these files stay unlisted
            stay = self._list(self._listed(start).join(gone, "file", "left_anti").coalesce(1))
            try:
                self.log.commit(number, {"lists": [stay, added, *[x for x in doc["lists"] if x not in set(start)]], "batches": doc["batches"]})
                return n
            except ManifestConflict:
                continue

    def vacuum(self) -> int:
        """Remove lists and data folders that no kept snapshot names; call it while nothing is written."""
        live = {x for doc in self.log.kept() for x in doc["lists"]}
        used = {r["folder"] for r in self._listed(sorted(live)).select(F.split("file", "/")[0].alias("folder")).distinct().collect()}
        gone = [f"lists/{x}" for x in self.log.folders(f"{self.path}/lists") if x not in live]
        gone += [f"data/{x}" for x in self.log.folders(f"{self.path}/data") if x not in used]
        for x in gone:
            remove_path(self.spark, f"{self.path}/{x}")
        return len(gone)

    # ---------------------------------------------------------- reading ---

    def _open(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{x}" for x in names])

    def plan(self, start: dt.date | str | None = None, end: dt.date | str | None = None,
             within: Mapping[str, tuple] | None = None, snapshot: int | None = None) -> list[str]:
        """The files that may hold rows of the asked date range (inclusive) and column ranges (``None``: open)."""
        asked = {DATE: (_number(start) if start is not None else None, _number(end) if end is not None else None)}
        asked |= {z: pair for z, pair in (within or {}).items() if z in self.zones}
        meets = [c for z, (lo, hi) in asked.items()
                 for c in ((F.col(f"hi_{z}") >= F.lit(lo)) if lo is not None else None, (F.col(f"lo_{z}") <= F.lit(hi)) if hi is not None else None)
                 if c is not None]
        return sorted(r["file"] for r in self.files(snapshot).where(reduce(and_, meets, F.lit(True))).select("file").collect())

    def read(self, start: dt.date | str | None = None, end: dt.date | str | None = None,
             within: Mapping[str, tuple] | None = None, snapshot: int | None = None) -> DataFrame:
        """The rows of the asked date range and column ranges, of the newest or a given snapshot.

        Rows with a NULL in an asked column are left out, as by a comparison."""
        rows = self._open(self.plan(start, end, within, snapshot))
        for column, (lo, hi) in ((within or {}).items()):
            if lo is not None:
                rows = rows.where(F.col(column) >= F.lit(lo))
            if hi is not None:
                rows = rows.where(F.col(column) <= F.lit(hi))
        if start is not None:
            rows = rows.where(_day(self.by) >= _number(start))
        if end is not None:
            rows = rows.where(_day(self.by) <= _number(end))
        return rows
