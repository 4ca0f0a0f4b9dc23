"""A ledger of published ids as levelled, sorted runs (K5, J4, T6).

Each acknowledged batch adds a run: its ids, sorted, with their key range
and a split-block Bloom filter (512-bit blocks, one bit in each of eight
words, ``bits_per_id`` bits an id).  ``fanout`` runs of one level are merged
to one of the next, so n batches leave O(log n) runs.  A manifest lists the
live runs and the batch numbers they cover; a merge that dies leaves nothing
but an unlisted folder.

``absent`` keeps the rows whose id no run holds.  The filters are asked
first; only runs that some id may be in are opened, and of those, when few
ids are asked, only the row groups whose range has one.  When most of very
many ids asked pass the filters, or neither the ids nor the filters can be
sent to all tasks, the runs themselves are asked in one join.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.hashing import packed_id, unpacked_id
from changelake.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, checked_broadcast, measured_size
from changelake.session import scratch_path
from changelake.operators.audit import unpublished
from changelake.sinks.lake import remove_path
from changelake.sinks.ledger import outbox_part
from changelake.sinks.manifest import ManifestConflict, ManifestLog, covered, joined

WORDS = 8
BLOCK_BITS = 64 * WORDS
FANOUT = 4
BITS_PER_ID = 16
# At most so many asked ids become a pushed filter.
MAX_PUSHED = 1000
# Bytes of a filter's block in a broadcast.
BLOCK_ROW_BYTES = 128
IDS_SCHEMA = "run string, id string"
BLOOM_SCHEMA = "run string, block long, " + ", ".join(f"w{i} long" for i in range(WORDS))


def _bits() -> list[Column]:
    """The bit of an id in each word of its block."""
    return _bits_of(F.xxhash64(F.lit(1), F.col("id")))


def _bits_of(second: Column) -> list[Column]:
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


class RunLedger:
    """The ledger below ``path``."""

    def __init__(self, spark: SparkSession, path: str, id_col: str = "audit_log_id", fanout: int = FANOUT, bits_per_id: int = BITS_PER_ID):
        self.spark, self.path, self.id_col, self.fanout, self.bits_per_id = spark, path.rstrip("/"), id_col, fanout, bits_per_id
        self.log = ManifestLog(spark, f"{self.path}/manifest")

    # ------------------------------------------------------------ state ---

    def runs(self) -> list[dict]:
        """The live runs."""
        doc = self.log.latest()[1]
        return doc["runs"] if doc else []

    def batches(self) -> list[list[int]]:
        """Closed intervals of the batch numbers that are acknowledged."""
        return joined([x for r in self.runs() for x in r["batches"]])

    def next_batch(self) -> int:
        """One more than the largest acknowledged batch number."""
        return max((b for _, b in self.batches()), default=-1) + 1

    def ids(self, runs: list[dict] | None = None) -> DataFrame:
        """``(id)`` of all runs, or of those given."""
        return self._ids(self.runs() if runs is None else runs).select(F.col("id").alias(self.id_col))

    def _ids(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], IDS_SCHEMA)
        return self.spark.read.schema(IDS_SCHEMA).parquet(*[f"{self.path}/runs/{r['run']}/ids" for r in runs])

    # ---------------------------------------------------------- writing ---

    def _write(self, ids: DataFrame, level: int, batches: list[list[int]]) -> dict:
        """A run of ``ids(id)``, not yet listed."""
        run = f"l{level}-{uuid.uuid4().hex[:12]}"
        at = f"{self.path}/runs/{run}"
        # equal ids meet in one range: no further exchange tells them apart
        ranged = ids.select(packed_id(F.col("id")).alias("id")).repartitionByRange("id").distinct()
        (ranged.select(F.lit(run).alias("run"), unpacked_id(F.col("id")).alias("id")).sortWithinPartitions("id")
         .write.option("compression", "zstd").parquet(f"{at}/ids"))
        entry = {"run": run, "level": level, "batches": joined(batches)}
        written = self._ids([entry])
        n, lo, hi = written.agg(F.count(F.lit(1)), F.min("id"), F.max("id")).first()
        entry |= {"n": n, "lo": lo, "hi": hi, "blocks": max(1, -(-n * self.bits_per_id // BLOCK_BITS))}
        block = F.pmod(F.xxhash64("id"), F.lit(entry["blocks"])).alias("block")
        # two numbers an id are dealt, the words of a block are built where they meet
        hashes = written.select(block, F.xxhash64(F.lit(1), F.col("id")).alias("second")).repartition("block")
        blocks = hashes.groupBy("block").agg(*[F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(_bits_of(F.col("second")))])
        blocks.select(F.lit(run).alias("run"), "*").write.parquet(f"{at}/bloom")
        return entry

    def append(self, ids: DataFrame, batch_id: int, merge: bool = True) -> bool:
        """Acknowledge the ids of a batch.  False if the batch was acknowledged already.

        A batch number whose run holds other ids is refused: listing it would lose them.
        NULL ids are left out."""
        ids = ids.select(F.col(self.id_col).cast("string").alias("id")).where("id is not null")
        if covered(self.batches(), batch_id):
            if not self.absent(ids.withColumnRenamed("id", self.id_col)).isEmpty():
                raise ValueError(f"batch id {batch_id} was used for other ids: {self.path}")
            return False
        entry = self._write(ids, 0, [[batch_id, batch_id]])
        while True:
            number, doc = self.log.latest()
            runs = doc["runs"] if doc else []
            if covered(joined([x for r in runs for x in r["batches"]]), batch_id):
                raise ManifestConflict(f"{self.path}: another writer acknowledged batch {batch_id}")
            try:
                self.log.commit(number, {"runs": [*runs, entry]})
                break
            except ManifestConflict:
                continue
        if merge:
            self.merge()
        return True

    def merge(self, before_commit: Callable[[], None] | None = None) -> int:
        """Merge levels that have ``fanout`` runs; the number of merges.  May run beside appends and reads.

        ``before_commit`` runs between the writing of a run and its listing (for tests of a crash there)."""
        done = 0
        while True:
            levels: dict[int, list[dict]] = {}
            for r in self.runs():
                levels.setdefault(r["level"], []).append(r)
            due = sorted(level for level, rs in levels.items() if len(rs) >= self.fanout)
            if not due:
                return done
            old = levels[due[0]]
            entry = self._write(self._ids(old).select("id"), due[0] + 1, [x for r in old for x in r["batches"]])
            if before_commit:
                before_commit()
            gone = {r["run"] for r in old}
            while True:
                number, doc = self.log.latest()
                if not gone <= {r["run"] for r in doc["runs"]}:
                    break  # another merge took them; this run stays unlisted
                try:
                    self.log.commit(number, {"runs": [*[r for r in doc["runs"] if r["run"] not in gone], entry]})
                    done += 1
                    break
                except ManifestConflict:
                    continue

    def vacuum(self) -> list[str]:
        """Remove the folders of runs that no kept manifest lists; call it while no append or merge runs."""
        live = {r["run"] for doc in self.log.kept() for r in doc["runs"]}
        gone = [name for name in self.log.folders(f"{self.path}/runs") if name not in live]
        for name in gone:
            remove_path(self.spark, f"{self.path}/runs/{name}")
        return gone

    # ---------------------------------------------------------- reading ---

    def _maybe(self, ids: DataFrame, runs: list[dict]) -> DataFrame:
        """``ids(id)`` -> ``(run, id)`` where the run's range and filter admit the id."""
        held = F.array(*[F.struct(F.lit(r["run"]).alias("run"), F.lit(r["blocks"]).cast("long").alias("blocks"),
                                  F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi")) for r in runs])
        asked = (ids.select("id", F.explode(held).alias("r")).where("id between r.lo and r.hi")
                 .select("id", "r.run", F.pmod(F.xxhash64("id"), F.col("r.blocks")).alias("block")))
        blooms = self.spark.read.schema(BLOOM_SCHEMA).parquet(*[f"{self.path}/runs/{r['run']}/bloom" for r in runs])
        if self._filters_fit(runs):
            met = asked.join(F.broadcast(blooms), ["run", "block"])
        else:  # few asked ids travel to the filters, not the filters to them
            met = blooms.join(checked_broadcast(asked), ["run", "block"])
        for i, bit in enumerate(_bits()):
            met = met.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
        return met.select("run", "id")

    @staticmethod
    def _filters_fit(runs: list[dict]) -> bool:
        """Whether the filters of the runs can be sent to all tasks."""
        blocks = sum(r["blocks"] for r in runs)
        return blocks <= DEFAULT_MAX_BROADCAST_ROWS and blocks * BLOCK_ROW_BYTES <= DEFAULT_MAX_BROADCAST_BYTES

    def _ask_runs(self, ids: DataFrame, runs: list[dict]) -> bool:
        """Whether so many ``ids(id)`` are asked, and so many of them pass the filters, that the runs are asked at once."""
        n, size = measured_size(ids)
        if n <= DEFAULT_MAX_BROADCAST_ROWS and size <= DEFAULT_MAX_BROADCAST_BYTES:
            return False
        return not self._filters_fit(runs) or 4 * self._maybe(ids, runs).count() > n

    def seen(self, df: DataFrame) -> DataFrame:
        """``(id)`` of the rows of ``df`` that a run holds (each once)."""
        runs = [r for r in self.runs() if r["n"]]
        ids = df.select(F.col(self.id_col).cast("string").alias("id")).where("id is not null")
        if not runs:
            return ids.limit(0).select(F.col("id").alias(self.id_col))
        if self._ask_runs(ids, runs):
            self.opened = sorted(r["run"] for r in runs)
            return self._ids(runs).select("id").distinct().join(ids, "id", "left_semi").select(F.col("id").alias(self.id_col))
        return self._seen_by_filters(ids.distinct(), runs)

    def _seen_by_filters(self, ids: DataFrame, runs: list[dict]) -> DataFrame:
        path = scratch_path(self.spark, "ledger-maybe")
        self._maybe(ids, runs).write.parquet(path)
        maybe = self.spark.read.schema(IDS_SCHEMA).parquet(path)
        hits = {r["run"]: r["n"] for r in maybe.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.opened = sorted(hits)
        held = self._ids([r for r in runs if r["run"] in hits])
        if sum(hits.values()) <= MAX_PUSHED:
            few = sorted({r["id"] for r in maybe.collect()})
            held = held.where(F.col("id").isin(few) & F.col("id").between(few[0], few[-1])) if few else held
        found = held.join(maybe, ["run", "id"], "left_semi")
        return found.select(F.col("id").alias(self.id_col)).distinct()

    def absent(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` whose id no run holds (a NULL id never is)."""
        runs = [r for r in self.runs() if r["n"]]
        if not runs:
            return df
        ids = df.select(F.col(self.id_col).cast("string").alias("id")).where("id is not null")
        if self._ask_runs(ids, runs):
            self.opened = sorted(r["run"] for r in runs)
            return unpublished(df, self.ids(runs), self.id_col).select(df.columns)
        gone = self._seen_by_filters(ids.distinct(), runs).withColumnRenamed(self.id_col, "_seen")
        return df.join(gone, F.col(self.id_col).cast("string") == F.col("_seen"), "left_anti")


def publish_once(batch: DataFrame, batch_id: int, sink: Callable[[DataFrame], None], ledger: RunLedger,
                 skip_empty: bool = False) -> bool:
    """Send a batch, acknowledge its ids, clear its outbox.  False if it was acknowledged already (nothing is sent), or,
    with ``skip_empty``, has no rows (its number stays free).

    What is sent and what is acknowledged come from one written copy.  A crash
    between the two sends the batch again: at least once."""
    spark = batch.sparkSession
    if covered(ledger.batches(), batch_id):
        return ledger.append(batch, batch_id)
    outbox = outbox_part(ledger.path, batch_id)
    batch.write.mode("overwrite").option("compression", "zstd").parquet(outbox)
    copy = spark.read.schema(batch.schema).parquet(outbox)
    if skip_empty and copy.isEmpty():
        remove_path(spark, outbox)
        return False
    sink(copy)
    ledger.append(copy, batch_id)
    remove_path(spark, outbox)
    return True
