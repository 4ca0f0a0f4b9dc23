"""Embedding near-dedup with Euclidean p-stable hashing.

Equal vectors of a label become one class.  A class's normalised vector is
projected on random Gaussian directions, shifted and quantised with a fixed
width; ``K`` such numbers make the key of one of ``T`` tables.  Classes that
share a key are compared by exact cosine in double precision, inside tasks.

K grows with the logarithm of the number of classes, so that unlike vectors
seldom meet, and T follows from K so that a pair at the threshold meets with
probability ``recall`` at least (closer pairs sooner).  A pair is counted in
the first table that it shares.  A bucket of many classes is dealt to pairs
of blocks, each a task's work; what leaves a task is one row per class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, materialize, slices
from changelake.llm.components import connected_components

COSINE = 0.98
WIDTH = 1.0
RECALL = 0.9999
BLOCK = 512
SEED = 1234


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that two points at a distance share one quantised projection."""
    r = width / distance
    cdf = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * cdf - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_shape(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Numbers per key and tables for ``n`` classes."""
    unlike = collision(math.sqrt(2))
    keys = max(2, math.ceil(math.log(max(n, 2)) / -math.log(unlike)))
    alike = collision(math.sqrt(2 - 2 * cosine)) ** keys
    return keys, max(1, math.ceil(math.log(1 - recall) / math.log(1 - alike)))


def signatures(classes: DataFrame, keys: int, tables: int, seed: int = SEED) -> DataFrame:
    """``classes`` with ``sig array<long>``: the key in each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in slices(batches, 2048):
            cid, vectors = batch.column(0), batch.column(1).to_pylist()
            sig = np.empty((len(vectors), tables), np.int64)
            dims = np.array([len(v) for v in vectors])
            for d in np.unique(dims):
                d = int(d)
                if d not in made:
                    rnd = np.random.default_rng([seed, d])
                    made[d] = (rnd.normal(size=(d, tables * keys)), rnd.uniform(0, WIDTH, tables * keys),
                               rnd.integers(1, 1 << 63, size=keys, dtype=np.uint64) | np.uint64(1))
                direction, shift, mix = made[d]
                mine = np.flatnonzero(dims == d)
                x = np.array([vectors[i] for i in mine], np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                cell = np.floor((x @ direction + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(mine), tables, keys)
                sig[mine] = (cell * mix).sum(axis=2, dtype=np.uint64).view(np.int64)
            yield pa.record_batch([cid, pa.array(list(sig), pa.list_(pa.int64()))], ["cid", "sig"])

    return map_arrow(classes.select("cid", "embedding"), run, "cid long, sig array<long>")


def _compare(cosine: float):
    """Blocks of a bucket -> for each class in it: links found here first, and the smallest class reached."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out = [(np.empty(0, np.int64),) * 3]
            for row in range(batch.num_rows):
                t, left, right = (batch.column(k)[row].as_py() for k in range(3))
                members = batch.column(3)[row].values
                block = members.field("block").to_numpy()
                cid = members.field("cid").to_numpy()
                m = members.field("m").to_numpy()
                x = np.array(members.field("embedding").to_pylist(), np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                sig = np.array(members.field("sig").to_pylist(), np.int64)
                a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
                near = x[a] @ x[b].T >= cosine
                if left == right:
                    near = np.triu(near, 1)
                i, j = np.nonzero(near)
                i, j = a[i], b[j]
                if not len(i):
                    continue
                first = np.ones(len(i), bool)
                for s in range(t):
                    first &= sig[i, s] != sig[j, s]
                links = np.zeros(len(cid), np.int64)
                np.add.at(links, i[first], m[j[first]])
                np.add.at(links, j[first], m[i[first]])
                root = cid.copy()
                while True:
                    low = np.minimum(root[i], root[j])
                    before = root.copy()
                    np.minimum.at(root, i, low)
                    np.minimum.at(root, j, low)
                    if (before == root).all():
                        break
                told = np.unique(np.concatenate([i, j]))
                out.append((cid[told], links[told], root[told]))
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["cid", "links", "root"])

    return run


def near_links(classes: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``classes(cid, label, embedding, m)`` -> ``(cid, links, root)``, any number of rows per class."""
    keys, tables = table_shape(classes.count(), cosine, recall)
    signed = materialize(classes.join(signatures(classes, keys, tables), "cid"), "embedding-signatures")
    rows = signed.select("cid", "label", F.size("embedding").alias("d"), F.posexplode("sig").alias("t", "key"))
    bucket = ["label", "d", "t", "key"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    members = (rows.join(sizes, bucket)
               .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
               .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
               .select(*bucket, "cid", "block", "left", "right"))
    whole = members.join(signed.select("cid", "m", "embedding", "sig"), "cid")
    grouped = whole.groupBy(*bucket, "left", "right").agg(F.collect_list(F.struct("block", "cid", "m", "embedding", "sig")).alias("members"))
    return map_arrow(grouped.select("t", "left", "right", "members"), _compare(cosine), "cid long, links long, root long")


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """``vectors(vec_id, embedding, label, ...)`` -> ``(vec_id, n_links, component_id, kept)``, one row per input row.

    * vectors are compared only within one non-NULL label (and one length);
    * a vector that is NULL, empty, zero or holds a NULL or non-finite number links with nothing;
    * ``n_links`` counts rows, equal vectors included; repeated rows are rows;
    * component_id is the smallest non-NULL vec_id reachable, itself included;
    * other columns are ignored; an empty table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").alias("label"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
           & ~bad & F.exists("embedding", lambda x: x != 0))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    fitting = rows.where("fit").drop("fit")
    classes = materialize(
        fitting.groupBy("label", "embedding").agg(F.count("*").alias("m"), F.min("vec_id").alias("first_id"))
        .withColumn("cid", F.monotonically_increasing_id()), "embedding-classes")
    found = materialize(near_links(classes.select("cid", "label", "embedding", "m"), cosine, recall, block), "embedding-links")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "embedding-components")
    rooted = (classes.join(roots.withColumnRenamed("v", "cid"), "cid", "left").join(links, "cid", "left")
              .withColumn("root", F.coalesce("root", "cid")))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(firsts, "root").select(
        "label", "embedding", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "embedding-named")
    told = fitting.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    return told.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
