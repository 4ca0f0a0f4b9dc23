"""Approximate nearest neighbours by adaptive dimension scans of inverted lists.

Vectors are normalised, turned by one random rotation, and dealt to the list
of their nearest centroid.  A query probes the lists of its nearest
centroids.  Within a list, columns are scanned in blocks: after ``d`` of
``D`` rotated dimensions the distance so far, scaled by ``D / d``, estimates
the whole one; a candidate is given up when the estimate is larger than the
query's present k-th distance by more than a test at ``1 + eps / sqrt(d)``
allows.  What remains is scored exactly, in double precision, on the vectors
as given.

Centroids are fitted on a bounded sample, and the share of the lists that a
query probes is the smallest that finds ``recall`` of the sample's own
neighbours; every row is indexed.  A list is stored in blocks of bounded
size, and so are the queries that probe it, so a list that holds a third of
all rows is many tasks' work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, materialize, slices

NEIGHBOURS = 5
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 400
MAX_LISTS = 1024
ROUNDS = 8
RECALL = 0.98
EPS = 2.1
STEP = 16
LIST_BLOCK = 4096
QUERY_BLOCK = 256
SEED = 4321
# Rounding of single-precision distances; what lies this near the k-th distance is scored exactly.
SLACK = 1e-5


class Index:
    """Rotation and centroids for one vector length, and the share of the lists to probe."""

    def __init__(self, sample: np.ndarray, dims: int, n: int, k: int, recall: float, max_lists: int, seed: int = SEED):
        rnd = np.random.default_rng([seed, dims])
        self.rotation = np.linalg.qr(rnd.normal(size=(dims, dims)))[0]
        x = sample @ self.rotation
        lists = max(1, min(max_lists, int(math.sqrt(n)), len(x) // 32))
        self.centroids = x[rnd.choice(len(x), lists, replace=False)] if len(x) else np.zeros((1, dims))
        for _ in range(ROUNDS if lists > 1 else 0):
            mine = self.nearest(x, 1)[:, 0]
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, mine, x)
            size = np.bincount(mine, minlength=lists)
            self.centroids[size > 0] = sums[size > 0] / size[size > 0, None]
        self.probes = self._tune(x, k, recall)

    def _distances(self, x: np.ndarray) -> np.ndarray:
        return (self.centroids ** 2).sum(1) - 2 * x @ self.centroids.T

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The nearest ``n`` lists of each vector, nearest first."""
        out = [np.argsort(self._distances(x[at:at + 1024]), axis=1, kind="stable")[:, :n] for at in range(0, len(x), 1024)]
        return np.concatenate(out) if out else np.empty((0, n), np.int64)

    def _tune(self, x: np.ndarray, k: int, recall: float) -> int:
        """How many lists hold ``recall`` of the neighbours that the sample's vectors have in the sample."""
        lists = len(self.centroids)
        if lists == 1 or len(x) <= k:
            return lists
        asked = np.arange(0, len(x), max(1, len(x) // SAMPLE_QUERIES))
        near = x[asked] @ x.T
        near[np.arange(len(asked)), asked] = -np.inf
        best = np.argpartition(-near, k, axis=1)[:, :k]
        place = np.empty((len(asked), lists), np.int64)
        np.put_along_axis(place, self.nearest(x[asked], lists), np.arange(lists)[None, :], axis=1)
        ranks = np.sort(np.take_along_axis(place, self.nearest(x, 1)[:, 0][best], axis=1).ravel())
        return int(ranks[math.ceil(recall * len(ranks)) - 1]) + 1

    def turned(self, x: np.ndarray) -> np.ndarray:
        return x @ self.rotation


def _unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    # a vector of very large or small numbers is brought near 1 before its length is taken
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact_cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine in double precision, the same for equal vectors wherever they stand."""
    query, rows = query / np.abs(query).max(), rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def adaptive_scan(query: np.ndarray, columns: list[np.ndarray], k: int, eps: float = EPS, counted: list | None = None) -> np.ndarray:
    """Places of the candidates that may be among the ``k`` nearest; ``columns``: the column blocks of their rotated vectors.

    ``counted``, if given, collects the number of dimensions read."""
    dims = sum(c.shape[1] for c in columns)
    alive, so_far, d, bound = np.arange(len(columns[0])), np.zeros(len(columns[0]), np.float32), 0, np.inf
    for at, block in enumerate(columns):
        width = block.shape[1]
        gap = (block if len(alive) == len(block) else block[alive]) - query[d:d + width]
        so_far = so_far + np.einsum("ij,ij->i", gap, gap)
        if counted is not None:
            counted.append(gap.size)
        d += width
        if len(alive) > k:
            # the present k-th distance: that of the k candidates nearest so far, taken whole
            seeds = np.argpartition(so_far, k - 1)[:k]
            rest, whole = d, so_far[seeds]
            for other in columns[at + 1:]:
                gap = other[alive[seeds]] - query[rest:rest + other.shape[1]]
                whole = whole + np.einsum("ij,ij->i", gap, gap)
                rest += other.shape[1]
            bound = min(bound, float(whole.max()))
        limit = bound * (1 + eps / math.sqrt(d)) ** 2 * d / dims if d < dims else bound
        keep = so_far <= limit + SLACK
        alive, so_far = alive[keep], so_far[keep]
    if len(alive) > k:
        alive = alive[so_far <= np.partition(so_far, k - 1)[k - 1] + SLACK]
    return alive


def _fit(spark: SparkSession, rows: DataFrame, k: int, recall: float, sample_rows: int, max_lists: int) -> dict[int, Index]:
    """An index for each vector length in the sample."""
    sample = rows.orderBy(F.xxhash64("vec_id", "rid"), "rid").limit(sample_rows).select("embedding").toArrow()["embedding"].to_pylist()
    by_dims: dict[int, list] = {}
    for v in sample:
        by_dims.setdefault(len(v), []).append(v)
    sizes = {r["d"]: r["n"] for r in rows.where(F.col("d").isin(list(by_dims))).groupBy("d").agg(F.count("*").alias("n")).collect()}
    return {d: Index(_unit(v), d, sizes[d], k, recall, max_lists) for d, v in by_dims.items()}


def _place(shared, probes: int | None):
    """``rid, embedding`` -> ``rid, list, order``: the nearest list, or those a query probes in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch in slices(batches, 1024):
            vectors = batch.column(1).to_pylist()
            dims = np.array([len(v) for v in vectors])
            for d in np.unique(dims):
                mine = np.flatnonzero(dims == d)
                rid = batch.column(0).take(pa.array(mine))
                if int(d) in indexes:
                    index = indexes[int(d)]
                    lists = index.nearest(index.turned(_unit([vectors[i] for i in mine])), 1 if probes else len(index.centroids))
                else:
                    lists = np.zeros((len(mine), 1), np.int64)
                yield pa.record_batch([rid, pa.array(list(lists.astype(np.int32)), pa.list_(pa.int32()))], ["rid", "lists"])

    return run


def _scan(shared, k: int, eps: float):
    """Pairs of a block of queries and a block of a list -> the best ``k`` of the block for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch in slices(batches, 16):
            for row in range(len(batch)):
                d = batch.column(0)[row].as_py()
                asked, held = batch.column(1)[row].values, batch.column(2)[row].values
                q = np.array(asked.field("embedding").to_pylist(), np.float64)
                x = np.array(held.field("embedding").to_pylist(), np.float64)
                q_id, x_id = asked.field("vec_id").to_numpy(), held.field("vec_id").to_numpy()
                turn = indexes[d].turned if d in indexes else (lambda v: v)
                qt, xt = turn(_unit(q)).astype(np.float32), turn(_unit(x)).astype(np.float32)
                columns = [np.ascontiguousarray(xt[:, a:a + STEP]) for a in range(0, d, STEP)]
                rid, vec, score = [], [], []
                own = np.sort(q_id)
                # a query's own rows are left out before the scan, so that they set no distance
                mine = np.isin(x_id, own)
                for i, one in enumerate(asked.field("rid").to_numpy().tolist()):
                    if mine.any() and (other := x_id != q_id[i]).sum() < len(x_id):
                        places = np.flatnonzero(other)
                        if not len(places):
                            continue
                        found = places[adaptive_scan(qt[i], [c[places] for c in columns], k, eps)]
                    else:
                        found = adaptive_scan(qt[i], columns, k, eps)
                    cos = exact_cosine(q[i], x[found])
                    best = np.lexsort((x_id[found], -cos))[:k]
                    rid += [one] * len(best)
                    vec += x_id[found[best]].tolist()
                    score += cos[best].tolist()
                yield pa.record_batch([pa.array(rid, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())], ["rid", "vec_id", "score"])

    return run


def _blocked(rows: DataFrame, keys: list[str], size: int, order: str, fields: list[str], name: str) -> DataFrame:
    """Rows of each key gathered in blocks of about ``size``: ``keys..., block, <name>``."""
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    dealt = rows.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64(order), F.ceil(F.col("n") / size)).cast("int"))
    return dealt.groupBy(*keys, "block").agg(F.collect_list(F.struct(*fields)).alias(name))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, recall: float = RECALL,
                       sample_rows: int = SAMPLE_ROWS, max_lists: int = MAX_LISTS, eps: float = EPS) -> DataFrame:
    """The ``k`` nearest rows of ``vectors(vec_id, embedding, ...)`` by cosine for each row of ``queries``, which has the same columns.

    Returns ``(query_id, rank, vec_id, score)``, nearest first, ties to the smaller vec_id; ``score`` is the exact cosine.

    * rows with a query's vec_id are its own and no candidates; a row with NULL vec_id, and a vector that is NULL, empty,
      zero or holds a NULL or non-finite number, takes no part;
    * vectors are compared only with those of one length; a query with fewer than ``k`` candidates gets all of them;
    * repeated rows of ``vectors`` are candidates each; each row of ``queries`` is a query;
    * the index is fitted on at most ``sample_rows`` rows and has at most ``max_lists`` lists for each vector length;
      ``recall`` is the share of neighbours that the probed lists are to hold;
    * other columns are ignored; empty tables give an empty result.
    """
    spark = vectors.sparkSession

    def fitting(df: DataFrame, name: str) -> DataFrame:
        bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        fit = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad
               & F.exists("embedding", lambda x: x != 0))
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.coalesce(fit, F.lit(False)))
        return materialize(rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("d", F.size("embedding")), name)

    rows, asked = fitting(vectors, "ann-rows"), fitting(queries, "ann-queries")
    indexes = _fit(spark, rows, k, recall, sample_rows, max_lists)
    shared = spark.sparkContext.broadcast(indexes)
    listed = map_arrow(rows.select("rid", "embedding"), _place(shared, 1), "rid long, lists array<int>").select("rid", F.col("lists")[0].alias("list"))
    listed = materialize(rows.join(listed, "rid"), "ann-lists")
    held = materialize(_blocked(listed, ["d", "list"], LIST_BLOCK, "rid", ["vec_id", "embedding"], "held"), "ann-blocks")

    # rows of each list, at most max_lists for a length in the sample, and one for another length
    sizes = listed.where(F.col("d").isin(list(indexes))).groupBy("d", "list").agg(F.count("*").alias("n"), F.count_distinct("vec_id").alias("ids")).collect()
    full: dict[int, np.ndarray] = {d: np.zeros(len(index.centroids), np.int64) for d, index in indexes.items()}
    for row in sizes:
        full[row["d"]][row["list"]] = row["n"]
    known = spark.sparkContext.broadcast({d: (index.probes, full[d]) for d, index in indexes.items()})

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = 1
                if d in known.value:
                    probes, counts = known.value[d]
                    # lists on until they hold k rows besides one of the query's own
                    n = max(probes, int(np.searchsorted(np.cumsum(counts[lists]), k + 1)) + 1)
                out.append(lists[:n])
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.int32()))], ["rid", "lists"])

    order = map_arrow(asked.select("rid", "embedding"), _place(shared, None), "rid long, lists array<int>")
    order = map_arrow(order.join(asked.select("rid", "d"), "rid").select("rid", "d", "lists"), probed, "rid long, lists array<int>")
    probing = materialize(asked.join(order, "rid").withColumn("list", F.explode("lists")).drop("lists"), "ann-probes")
    asking = _blocked(probing, ["d", "list"], QUERY_BLOCK, "rid", ["rid", "vec_id", "embedding"], "asked").withColumnRenamed("block", "ask")
    pairs = asking.join(held, ["d", "list"])
    near = map_arrow(pairs.select("d", "asked", "held"), _scan(shared, k, eps), "rid long, vec_id long, score double")
    first = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return best.join(asked.select("rid", F.col("vec_id").alias("query_id")), "rid").select("query_id", "rank", "vec_id", "score")
