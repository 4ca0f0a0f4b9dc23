"""SimHash near-dedup with covering locality-sensitive hashing.

A 64-bit fingerprint per text; fingerprints that differ in at most
``radius`` bits are linked, and documents of linked fingerprints share a
component.  Bit i gets a non-zero vector m(i) of radius+1 bits; table v (a
non-zero vector) keeps the bits with <m(i), v> odd.  Any ``radius`` differing
bits leave some v orthogonal to all their vectors, so every pair within the
radius agrees on the kept bits of at least one of the 2^(radius+1)-1 tables.

A bucket (table, kept bits) is compared as a whole inside a task only while
it is small.  A larger one is split exactly: its free bits are cut into
radius+1 chunks, and a pair within the radius agrees on one chunk at least,
so adding one chunk to the key at a time loses no pair.  A bucket with at
most ``TAIL_BITS`` free bits holds at most 2^TAIL_BITS fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, materialize, slices
from changelake.llm.components import connected_components

BITS = 64
SEED = 42
BUCKET_ROWS = 512
TAIL_BITS = 12
HASH_BLOCK = 1 << 16
ALL_ONES = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text over its word shingles, repeats included (no words: 0)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    total, ones = 0, np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    block: list[int] = []
    for part in parts:
        block.append(digest(part, SEED))
        if len(block) == HASH_BLOCK:
            ones += _bit_counts(block)
            total += len(block)
            block = []
    if block:
        ones += _bit_counts(block)
        total += len(block)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(len(hashes), 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: one row per document, the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(narrow, run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def covering_masks(radius: int) -> list[int]:
    """Bit masks of the covering family for ``radius``."""
    top = 1 << (radius + 1)
    vector = [1 + i % (top - 1) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() % 2) for v in range(1, top)]


def _finer(mask: int, radius: int) -> list[int]:
    """The mask with each of radius+1 chunks of its free bits added."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[c::radius + 1]) for c in range(radius + 1)]


def _forests(radius: int):
    """Edges from each member of a bucket to the smallest one it reaches inside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            members = batch.column(0)
            out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for row in range(len(members)):
                fps = np.unique(members[row].values.to_numpy())
                n = len(fps)
                near = np.empty((n, n), bool)
                bits = fps.view(np.uint64)
                for at in range(0, n, 256):
                    near[at:at + 256] = np.bitwise_count(bits[at:at + 256, None] ^ bits[None, :]) <= radius
                label = np.arange(n)
                while True:
                    low = np.where(near, label[None, :], n).min(axis=1)
                    low = low[low]
                    if (low == label).all():
                        break
                    label = low
                moved = label != np.arange(n)
                out_a.append(fps[moved])
                out_b.append(fps[label[moved]])
            yield pa.record_batch([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    return run


def _masks_for(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)) for m in masks])


def near_edges(fps: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fps(fp)`` distinct -> edges ``(a, b)`` that connect exactly what links within ``radius`` connect."""
    masks = covering_masks(radius)
    rows = fps.select("fp", F.explode(_masks_for(masks)).alias("mask"))
    found = []
    while True:
        rows = rows.withColumn("kept", F.col("fp").bitwiseAND(F.col("mask")))
        key = ["mask", "kept"]
        buckets = materialize(
            rows.groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1"),
            "simhash-buckets")
        found.append(buckets.where("n = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b"))
                     .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        tail = F.bit_count("mask") >= BITS - TAIL_BITS
        whole = (F.col("n") <= bucket_rows) | tail
        members = rows.join(buckets.where((F.col("n") > 2) & whole).select(*key), key)
        found.append(map_arrow(members.groupBy(*key).agg(F.collect_list("fp").alias("fps")).select("fps"),
                               _forests(radius), "a long, b long"))
        large = buckets.where((F.col("n") > 2) & ~whole).select(*key)
        if large.isEmpty():
            break
        finer = {m: _finer(m, radius) for m in masks}
        masks = sorted({m for ms in finer.values() for m in ms})
        children = F.create_map(*[x for m, ms in finer.items() for x in (F.lit(_signed(m)), _masks_for(ms))])
        rows = materialize(
            rows.join(large, key).select("fp", F.explode(F.element_at(children, F.col("mask"))).alias("mask")).distinct(),
            "simhash-finer")
    return reduce(DataFrame.unionAll, found)


def simhash_dedup(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, fingerprint, component_id)``, one row per input row.

    * words are runs of anything but ASCII white space, A-Z lower-cased; a
      text with fewer words than a shingle is one shingle; NULL, empty and
      blank texts have fingerprint zero and are linked like any other;
    * repeated rows stay repeated; rows that share a doc_id share nothing else;
    * component_id is the smallest non-NULL doc_id reachable (NULL when there is none);
    * other columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    each = materialize(fingerprints(docs, shingle), "simhash-fingerprints")
    distinct = materialize(each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = materialize(connected_components(near_edges(distinct.select("fp"), radius), "simhash-components"), "simhash-roots")
    rooted = (distinct.join(roots.withColumnRenamed("v", "fp"), "fp", "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(firsts, "root").select("fp", "component_id"), "simhash-named")
    return each.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
