"""Line dedup with two Bloom filters.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased.  Pass 1 hashes the keys of every document (repeats inside a
batch of documents are merged before the shuffle) and deals the hashes to
segments; each segment puts a hash into its once-seen filter, and into its
twice-seen filter if the first had it already.  Pass 2 reads the texts again
and shuffles only keys that the twice-seen filter holds; these are counted by
their exact text, and the largest document id of each is chosen.  Pass 3
takes the lines out of the other documents.

Bloom filters never miss a member, so no repeated key is lost; false members
only cost a shuffled row.  The twice-seen filter is broadcast: its size is
fixed by ``twice_bits`` at most.  The once-seen filters stay in their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.llm.common import map_arrow, materialize, slices

MIN_CHARS = 40
MIN_DOCS = 5
WHITE = " \t\n\x0b\x0c\r"
SEED = 42
SEGMENT_LINES = 1 << 18
ONCE_BITS_PER_LINE = 16
TWICE_BITS_PER_LINE = 4
TWICE_BITS = 1 << 28
MERGE_LINES = 1 << 16


def key_of(line: str) -> str:
    """White space stripped at both ends, A-Z lower-cased."""
    key = line.strip(WHITE)
    return key.lower() if key.isascii() else key.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), SEED)


def _long_keys(text: str | None, min_chars: int) -> set[str]:
    return {k for line in (text or "").split("\n") if len(line) >= min_chars and len(k := key_of(line)) >= min_chars}


def _places(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two positions below ``size`` for each hash."""
    n = np.uint64(size)
    return (h & np.uint64(0xFFFFFFFF)) % n, (h >> np.uint64(24)) % n


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    return (h >> np.uint64(40)) % np.uint64(segments)


class Seen:
    """The pair of filters of one segment (one byte per bit while in use)."""

    def __init__(self, once_bits: int, twice_bits: int):
        self.once = np.zeros(once_bits, bool)
        self.twice = np.zeros(twice_bits, bool)

    def add(self, h: np.ndarray, repeated: np.ndarray) -> None:
        """``h``: distinct hashes; ``repeated``: known to be seen twice already."""
        p, q = _places(h, len(self.once))
        again = repeated | (self.once[p] & self.once[q])
        self.once[p] = True
        self.once[q] = True
        p, q = _places(h[again], len(self.twice))
        self.twice[p] = True
        self.twice[q] = True


def _line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(h, repeated)``: the key hashes of each document, merged over batches of documents."""
    def flush(counts: dict[int, bool]) -> pa.RecordBatch:
        h = np.fromiter(counts.keys(), np.uint64, len(counts))
        twice = np.fromiter(counts.values(), bool, len(counts))
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(twice)], ["h", "repeated"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, bool] = {}
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for key in _long_keys(text, min_chars):
                    h = _hash(key)
                    counts[h] = h in counts
            if len(counts) >= MERGE_LINES:
                yield flush(counts)
                counts = {}
        yield flush(counts)

    return map_arrow(docs.select(F.col("text").cast("string")), run, "h long, repeated boolean")


def twice_seen(hashes: DataFrame, n: int, twice_bits: int) -> tuple[int, int, DataFrame]:
    """Segments, bits of each, and ``(segment, bits)`` of the twice-seen filters."""
    segments = max(1, -(-n // SEGMENT_LINES))
    each = -(-n // segments)
    once = max(64, ONCE_BITS_PER_LINE * each)
    twice = max(64, min(TWICE_BITS_PER_LINE * each, twice_bits // segments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the rows come segment by segment: one pair of filters is held at a time
        current, seen = -1, None

        def made() -> pa.RecordBatch:
            return pa.record_batch([pa.array([current]), pa.array([np.packbits(seen.twice).tobytes()], pa.binary())], ["segment", "bits"])

        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            known = batch.column(1).to_numpy(zero_copy_only=False)
            h, where, counts = np.unique(h, return_inverse=True, return_counts=True)
            repeated = (counts > 1) | (np.bincount(where, known, len(h)) > 0)
            segment = _segment(h, segments)
            for s in sorted(map(int, np.unique(segment))):
                if s != current:
                    if seen is not None:
                        yield made()
                    current, seen = s, Seen(once, twice)
                mine = segment == s
                seen.add(h[mine], repeated[mine])
        if seen is not None:
            yield made()

    segment = F.expr(f"shiftrightunsigned(h, 40) % {segments}")
    dealt = hashes.repartition(segment).sortWithinPartitions(segment)
    return segments, twice, map_arrow(dealt, run, "segment long, bits binary")


def _suspects(docs: DataFrame, min_chars: int, segments: int, size: int, filters: DataFrame) -> DataFrame:
    """``(h, key, doc_id)``: each document's keys that may be repeated."""
    bits = {r.segment: bytes(r.bits) for r in filters.collect()}  # at most twice_bits in all
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {s: np.frombuffer(b, np.uint8) for s, b in shared.value.items()}

        def has(h: np.ndarray) -> np.ndarray:
            found = np.zeros(len(h), bool)
            segment = _segment(h, segments)
            for s in np.unique(segment):
                mine = np.flatnonzero(segment == s)
                if int(s) in held:
                    hit = np.ones(len(mine), bool)
                    for p in _places(h[mine], size):
                        hit &= (held[int(s)][p >> np.uint64(3)] >> (np.uint64(7) - (p & np.uint64(7))).astype(np.uint8)) & 1 == 1
                    found[mine] = hit
            return found

        for batch in slices(batches):
            keys, ids, hashes = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for key in _long_keys(text, min_chars):
                    keys.append(key)
                    ids.append(doc_id)
                    hashes.append(_hash(key))
            h = np.array(hashes, np.uint64)
            hit = np.flatnonzero(has(h))
            yield pa.record_batch([pa.array(h[hit].view(np.int64)), pa.array([keys[i] for i in hit], pa.string()),
                                   pa.array([ids[i] for i in hit], pa.int64())], ["h", "key", "doc_id"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "h long, key string, doc_id long")


def _without(docs: DataFrame) -> DataFrame:
    """``(doc, gone)`` -> ``(doc, kept_text, n_lines, n_dropped)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(batch.column(0).field("text").cast(pa.string()).to_pylist(), batch.column(1).to_pylist()):
                lines = (text or "").split("\n")
                kept = lines
                if gone:
                    drop = set(gone)
                    kept = [x for x in lines if _signed_hash(key_of(x)) not in drop]
                texts.append(None if text is None else "\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                                   pa.array(n_dropped, pa.int64())], ["doc", "kept_text", "n_lines", "n_dropped"])

    schema = T.StructType([docs.schema["doc"], T.StructField("kept_text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return map_arrow(docs.select("doc", "gone"), run, schema)


def _signed_hash(key: str) -> int:
    h = _hash(key)
    return h - (1 << 64) if h >> 63 else h


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, twice_bits: int = TWICE_BITS) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per input row: ``doc`` (the input row as a struct),
    ``kept_text``, ``n_lines``, ``n_dropped``.

    * lines are cut at newlines only; a key of at least ``min_chars`` code
      points found in at least ``min_docs`` rows loses its lines in all but
      the rows with the largest doc_id holding it (there all its lines stay);
    * each row counts as a document; rows repeating the largest doc_id all keep the line;
    * a NULL doc_id counts as smaller than any other;
    * a NULL text is one empty line, and ``kept_text`` stays NULL;
    * an empty table gives an empty result.
    """
    hashes = materialize(_line_hashes(docs, min_chars), "lines-hashes")
    n = hashes.count()
    segments, size, filters = twice_seen(hashes, n, twice_bits)
    suspects = materialize(_suspects(docs, min_chars, segments, size, filters), "lines-suspects")
    confirmed = (suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
                 .where(F.col("n") >= min_docs).select("key", "keeper"))
    confirmed = materialize(confirmed, "lines-confirmed")
    gone = (suspects.join(confirmed, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_set("h").alias("gone")))
    whole = docs.select(F.struct("*").alias("doc"))
    return _without(whole.join(gone, F.col("doc.doc_id").cast("long").eqNullSafe(F.col("of_id")), "left"))
