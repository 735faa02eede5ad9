"""Nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are rotated at random and kept in column blocks. Inside each probed list a query adds up partial
squared distances block by block; after each block a hypothesis test (ADSampling; Gao and Long, 2023)
drops the candidates whose partial distance, scaled to all dimensions, lies significantly beyond the
query's tenth best so far. What remains is measured exactly, in double precision, on the original vectors.

Fit: k-means on at most ``sample`` vectors (by hash), on the driver. How many lists a query probes is
calibrated there: the least share of lists that finds ``recall`` of the sample's true neighbours.
Every vector is indexed.

Scale: lists are cut into slices of at most about ``slice_rows`` and the queries that probe one list into blocks, so that no
task holds more than one slice and one block; a list's rows are copied once for each block of its own queries. Each query first scans its nearest list; its tenth best then prunes
all other lists, which return only what beats it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, written
from kindred.llm.vectors import lists, matrix, usable

BLOCK = 16
#: Significance of the test: larger keeps candidates longer.
EPSILON = 2.1


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return squares(x)[None, :] - 2 * (q @ x.T) + squares(q)[:, None]


class Index:
    """Rotation, centroids and share of lists to probe; a few MB at most."""

    def __init__(self, x: np.ndarray, n: int, k: int, recall: float, list_rows: int, max_lists: int, seed: int):
        rng = np.random.default_rng(seed)
        dims = x.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        n_lists = int(max(1, min(max_lists, n // list_rows, len(x) // 8 or 1)))
        c = x[rng.permutation(len(x))[:n_lists]].copy()
        for _ in range(10):
            near = distances(c, x).argmin(axis=1)
            for i in range(n_lists):
                if (own := near == i).any():
                    c[i] = x[own].mean(axis=0)
        self.centroids = c
        self.share = self._calibrate(x, k, recall, rng)

    def _calibrate(self, x: np.ndarray, k: int, recall: float, rng) -> float:
        n_lists = len(self.centroids)
        if n_lists < 4:
            return 1.0
        mine = rng.permutation(len(x))[:200]
        d = distances(x, x[mine])
        d[np.arange(mine.size), mine] = np.inf
        true = np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :k]
        near = distances(self.centroids, x).argmin(axis=1)
        order = np.argsort(distances(self.centroids, x[mine]), axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n_lists)[None].repeat(mine.size, 0), 1)
        found = np.take_along_axis(rank, near[true], 1).ravel()
        return float((np.quantile(found, recall, method="higher") + 1) / n_lists)

    def assign(self, x: np.ndarray) -> np.ndarray:
        return distances(self.centroids, x).argmin(axis=1)

    def probes(self, q: np.ndarray, sizes: np.ndarray, k: int) -> list[np.ndarray]:
        """Lists of each query, nearest first: the calibrated share, and as many as hold k + 1 rows."""
        out = []
        at_least = int(np.ceil(self.share * len(self.centroids)))
        for order in np.argsort(distances(self.centroids, q), axis=1):
            held = np.cumsum(sizes[order])
            enough = int(np.searchsorted(held, k + 1)) + 1
            out.append(order[: max(at_least, enough)])
        return out


def scan(ids: np.ndarray, x: np.ndarray, turned: list[np.ndarray], query_id: int, q: np.ndarray, qt: np.ndarray, best: float, k: int):
    """(ids, distances) of the at most ``k`` nearest rows of a list that are within ``best``."""
    dims = x.shape[1]
    alive = np.flatnonzero(ids != query_id)
    if not np.isfinite(best):  # start from some rows in full
        if alive.size <= k:
            d = np.sqrt(((x[alive] - q) ** 2).sum(axis=1))
            return ids[alive], d
        some = alive[:: max(1, alive.size // (4 * k))]
        best = np.partition(np.sqrt(((x[some] - q) ** 2).sum(axis=1)), k - 1)[k - 1] if some.size >= k else np.inf
    part = np.zeros(alive.size)
    limit, seen = best * best * (1 + 1e-9), 0
    for block in turned:
        here = block[:, alive] - qt[seen : seen + block.shape[0], None]
        part += np.einsum("ij,ij->j", here, here)
        seen += block.shape[0]
        slack = (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9
        stay = part * (dims / seen) <= limit * slack
        if not stay.all():
            alive, part = alive[stay], part[stay]
        if not alive.size:
            break
    d = np.sqrt(((x[alive] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[alive], d))[:k]
    order = order[d[order] <= best]
    return ids[alive][order], d[order]


_FOUND = "query_id long, vec_id long, score double"


def _scan_cells(index, k: int, dims: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if rows.num_rows and queries.num_rows:
            x = matrix(rows.column("embedding"), dims)
            ids = rows.column("vec_id").to_numpy()
            rotation = index.value.rotation
            spun = np.ascontiguousarray((x @ rotation).T)
            turned = [spun[i : i + BLOCK] for i in range(0, dims, BLOCK)]
            q = matrix(queries.column("embedding"), dims)
            qt = q @ rotation
            for i, (query, best) in enumerate(zip(queries.column("query_id").to_pylist(), queries.column("best").to_pylist(), strict=True)):
                found, d = scan(ids, x, turned, query, q[i], qt[i], np.inf if best is None else best, k)
                out_q.append(np.full(found.size, query))
                out_v.append(found)
                out_s.append(d)
        join = lambda parts, kind: np.concatenate([*parts, np.empty(0, kind)]).astype(kind)
        return pa.table({"query_id": join(out_q, np.int64), "vec_id": join(out_v, np.int64), "score": join(out_s, np.float64)})

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, recall: float = 0.95, sample: int = 20_000,
    list_rows: int = 400, max_lists: int = 1024, slice_rows: int = 20_000, query_block: int = 2_000, seed: int = 11,
) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for each of ``queries`` (all of them by default).

    Both: ``vec_id`` and ``embedding``. Returns ``query_id, rank, vec_id, score`` by Euclidean distance, ties to the
    smaller vec_id; fewer than ``k`` rows where there are fewer candidates. A query is never its own
    candidate. See ``usable`` for vectors that take no part and for repeated ids; other columns are
    not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    base, dims = usable(vectors)
    queries = base if queries is None else usable(queries, dims)[0]
    n = base.count()
    picked = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = spark.sparkContext.broadcast(Index(matrix(picked.column(0), dims), n, k, recall, list_rows, max_lists, seed))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = index.value.assign(matrix(b.column(1), dims)) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), b.column(0), b.column(1)], names=["list", "vec_id", "embedding"])

    rows = written(base.mapInArrow(assign, "list int, vec_id long, embedding array<double>"), "lists")
    sizes = np.zeros(len(index.value.centroids), np.int64)
    for r in rows.groupBy("list").count().collect():  # one row per list: max_lists at most
        sizes[r["list"]] = r["count"]
    slices = np.maximum(1, -(-sizes // slice_rows))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = matrix(b.column(1), dims)
            found = index.value.probes(q, sizes, k) if b.num_rows else []
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), lists(q), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["query_id", "embedding", "probes"])

    asked = queries.select(F.col("vec_id").alias("query_id"), "embedding")
    asked = written(asked.mapInArrow(probe, "query_id long, embedding array<double>, probes array<int>"), "queries")
    per_list = lambda values: F.element_at(F.array(*(F.lit(int(v)) for v in values)), F.col("list") + 1)
    n_slices = per_list(slices)
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id"), n_slices).cast("int"))
    cell = ["list", "slice", "block"]

    def scanned(probing: DataFrame) -> DataFrame:
        asking = np.zeros(len(sizes), np.int64)
        for r in probing.groupBy("list").count().collect():  # max_lists rows at most
            asking[r["list"]] = r["count"]
        n_blocks = per_list(-(-asking // query_block))
        probing = probing.withColumn("block", F.pmod(F.xxhash64("query_id"), n_blocks).cast("int"))
        probing = probing.withColumn("slice", F.explode(F.sequence(F.lit(0), n_slices - 1)))
        copies = rows.where(n_blocks > 0).withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        cells = copies.groupBy(*cell).cogroup(probing.groupBy(*cell))
        return cells.applyInArrow(_scan_cells(index, k, dims), _FOUND)

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    home = asked.select("query_id", "embedding", F.col("probes")[0].alias("list"), F.lit(None).cast("double").alias("best"))
    top = scanned(home).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    first = written(top, "first")
    best = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("best"))
    others = asked.select("query_id", "embedding", F.explode(F.slice("probes", 2, F.greatest(F.size("probes"), F.lit(1)))).alias("list"))
    others = others.join(best, "query_id", "left")
    both = first.drop("rank").unionByName(scanned(others))
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
