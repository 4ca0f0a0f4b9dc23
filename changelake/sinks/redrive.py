"""Re-drive of the quarantine: schema versions tried in order, each message moved once.

A message that the lake job could not use may be of an older or newer schema.
A run takes all live quarantine batches, reads each message as VARIANT, and
decodes it by the first version that fits; those rows go to the lake, the
others stay in the quarantine, both under the run's own (negative) batch id.
The run is noted before it writes and closed after, in a log of numbered
documents.  A run that was lost is done again as noted, over the same batches
and by the same versions, and overwrites what it wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.operators.envelope import PAYLOAD_FIELDS, TS_MS_RANGE, add_date_parts
from changelake.session import scratch_path
from changelake.sinks.lake import BATCH_COLUMN, LAKE_PARTITIONS, write_batch
from changelake.sinks.manifest import ManifestLog, covered, joined


@dataclass(frozen=True)
class MessageVersion:
    """Paths of an envelope's parts; ``keys`` maps a row field to its key where the two differ."""

    name: str
    before: str = "$.payload.before"
    after: str = "$.payload.after"
    op: str = "$.payload.op"
    ts_ms: str = "$.payload.ts_ms"
    keys: dict[str, str] = field(default_factory=dict)


def _image(doc: Column, path: str, row_schema: T.StructType, keys: dict[str, str]) -> tuple[Column, Column, Column]:
    """``(row, there, fits)`` of one image: an object whose values, where given, have the fields' types."""
    whole = F.try_variant_get(doc, path, "variant")
    absent = whole.isNull() | F.is_variant_null(whole)
    fits, fields = F.schema_of_variant(whole).startswith("OBJECT"), []
    for f in row_schema.fields:
        at = f"{path}.{keys.get(f.name, f.name)}"
        raw, typed = F.try_variant_get(doc, at, "variant"), F.try_variant_get(doc, at, f.dataType.simpleString())
        fits = fits & (typed.isNotNull() | raw.isNull() | F.is_variant_null(raw))
        fields.append(typed.alias(f.name))
    return F.when(~absent, F.struct(*fields)), ~absent, absent | fits


def decode_versions(df: DataFrame, row_schema: T.StructType, versions: Sequence[MessageVersion],
                    keep: Sequence[str] = (), value: str = "message") -> DataFrame:
    """``keep`` columns and ``decoded``: ``(version, before, after, op, ts_ms)`` by the first version that fits, or NULL.

    A version fits when the message is JSON with its ``op``, a ``ts_ms`` that has a date, and an image or two whose
    values have the row's types.  NULL, empty and broken messages fit none.
    """
    # explode of a one-element array: the text is parsed once, not once a use
    rows = df.select(*keep, F.explode(F.array(F.try_parse_json(F.col(value).cast("string")))).alias("_doc"))
    doc, tried = F.col("_doc"), []
    for v in versions:
        before, has_before, before_fits = _image(doc, v.before, row_schema, v.keys)
        after, has_after, after_fits = _image(doc, v.after, row_schema, v.keys)
        op, ts_ms = F.try_variant_get(doc, v.op, "string"), F.try_variant_get(doc, v.ts_ms, "bigint")
        fits = op.isNotNull() & ts_ms.between(*TS_MS_RANGE) & (has_before | has_after) & before_fits & after_fits
        tried.append(F.when(fits, F.struct(F.lit(v.name).alias("version"), before.alias("before"), after.alias("after"),
                                           op.alias("op"), ts_ms.alias("ts_ms"))))
    return rows.select(*keep, F.coalesce(*tried).alias("decoded"))


class Redrive:
    """Moves messages from ``quarantine`` to ``lake``; its log is below ``state``.  One runner at a time."""

    def __init__(self, spark: SparkSession, lake: str, quarantine: str, state: str):
        self.spark, self.lake, self.quarantine = spark, lake, quarantine.rstrip("/")
        self.log = ManifestLog(spark, state)

    def _document(self) -> tuple[int, dict]:
        number, doc = self.log.latest()
        return number, doc or {"taken": [], "rest": None, "runs": 0, "open": None}

    def _landed(self) -> list[int]:
        """Batches that the lake job wrote to the quarantine."""
        names = [n.removeprefix(f"{BATCH_COLUMN}=") for n in self.log.folders(self.quarantine) if n.startswith(f"{BATCH_COLUMN}=")]
        return sorted(int(n) for n in names if n.isdigit())

    def _rows(self, batches: list[list[int]]) -> DataFrame:
        """The quarantine's rows of the closed intervals of batches."""
        inside = F.lit(False)
        for a, b in batches:
            inside = inside | F.col(BATCH_COLUMN).between(a, b)
        return self.spark.read.parquet(self.quarantine).where(inside)

    def _live(self, doc: dict) -> list[list[int]]:
        """Batches whose messages are in the quarantine only: the last run's rest, and what no run has taken."""
        rest = [] if doc["rest"] is None else [[doc["rest"], doc["rest"]]]
        return rest + joined([[n, n] for n in self._landed() if not covered(doc["taken"], n)])

    def read_quarantine(self) -> DataFrame:
        """The messages that no run has moved."""
        return self._rows(self._live(self._document()[1]))

    def run(self, row_schema: T.StructType, versions: Sequence[MessageVersion], keep: Sequence[str] = (), tz: str = "UTC",
            before_close: Callable[[], None] | None = None) -> None:
        """Finish the run that was lost, if any, then move what fits one of ``versions``.

        ``keep`` names the columns that lake and quarantine carry beside the message's own.
        """
        number, doc = self._document()
        if doc["open"]:
            number, doc = self._finish(number, doc, before_close)
        batches = self._live(doc)
        if not batches:
            return
        note = {"run": -(doc["runs"] + 1), "batches": batches, "row": row_schema.json(), "keep": list(keep), "tz": tz,
                "versions": [asdict(v) for v in versions]}
        doc = {**doc, "open": note}
        self._finish(self.log.commit(number, doc), doc, before_close)

    def _finish(self, number: int, doc: dict, before_close: Callable[[], None] | None) -> tuple[int, dict]:
        note = doc["open"]
        keep, versions = note["keep"], [MessageVersion(**v) for v in note["versions"]]
        rows = self._rows(note["batches"])
        path = scratch_path(self.spark, "redrive")
        decode_versions(rows, T.StructType.fromJson(json.loads(note["row"])), versions,
                        keep=[*keep, "message", "bad_reason"]).write.parquet(path)
        tried = self.spark.read.parquet(path)
        good = tried.where("decoded is not null").select(*keep, *[F.col(f"decoded.{f}").alias(f) for f in PAYLOAD_FIELDS])
        bad = tried.where("decoded is null").drop("decoded")
        # old messages are of many days: few files a day, a hot day over several tasks
        placed = add_date_parts(good, "ts_ms", note["tz"]).hint("rebalance", *LAKE_PARTITIONS)
        write_batch(placed, bad, note["run"], self.lake, self.quarantine)
        if before_close:
            before_close()
        taken = joined(doc["taken"] + [b for b in note["batches"] if b[0] >= 0])
        doc = {"taken": taken, "rest": note["run"], "runs": doc["runs"] + 1, "open": None}
        return self.log.commit(number, doc), doc
