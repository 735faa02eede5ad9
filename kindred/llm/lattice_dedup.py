"""Embedding near-dedup by lattice hashing.

In each of ``tables``, three random projections to eight dimensions are decoded to points of the E8 lattice (Conway
and Sloane, 1982) and hashed together to a cell. A vector stands in its own cell and probes the cells
that replace any of its three points by the nearest neighbouring lattice point. Pairs that meet are
verified by cosine in double precision on the original vectors.

Scale: equal vectors collapse, by a 128-bit digest, to one representative with a count. Only ids travel to the cells; vectors join those
in which somebody meets. A crowded cell is dealt out as pairs of blocks, compared as matrix products, and
returns counts and a spanning forest per representative, never its pairs. A pair that meets in several
cells is counted in the first only, which both vectors' codes tell without any exchange: projections
work on integers, so codes come out alike in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, components, written
from kindred.llm.texthash import U, mix, seeds
from kindred.llm.vectors import matrix, usable

TABLES, POINTS, DIMS8 = 16, 3, 8
#: Cell width at similarity s, in units of sqrt(2 - 2 s).
WIDTH = 6.83
BLOCK = 2_000
_QUANTUM = float(1 << 20)


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i in range(8):
        for j in range(i):
            for s in (1, -1):
                for t in (1, -1):
                    v = np.zeros(8)
                    v[i], v[j] = s, t
                    out.append(v)
    for m in range(256):
        v = np.array([-0.5 if m >> i & 1 else 0.5 for i in range(8)])
        if (v < 0).sum() % 2 == 0:
            out.append(v)
    return np.array(out)


_ROOTS = _roots()
_KEY = seeds(8, 21) | U(1)
_POINT_KEY = seeds(POINTS, 22) | U(1)


def _checkerboard(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8: integers with an even sum."""
    f = np.rint(x)
    odd = np.flatnonzero(f.sum(axis=-1).astype(np.int64) & 1)
    off = x[odd] - f[odd]
    worst = np.abs(off).argmax(axis=-1)
    f[odd, worst] += np.where(off[np.arange(odd.size), worst] >= 0, 1.0, -1.0)
    return f


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 + 1/2."""
    a, b = _checkerboard(x), _checkerboard(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=-1) <= ((x - b) ** 2).sum(axis=-1)
    return np.where(nearer[:, None], a, b)


def _hash(points: np.ndarray) -> np.ndarray:
    return mix(((points * 2).astype(np.int64).astype(U) * _KEY).sum(axis=-1, dtype=U))


class Lattice:
    def __init__(self, dims: int, similarity: float, tables: int, seed: int):
        rng = np.random.default_rng(seed)
        self.tables = tables
        self.projection = np.rint(rng.normal(size=(dims, tables * POINTS * DIMS8)) * 1024)
        self.width = WIDTH * np.sqrt(2 - 2 * similarity) * 1024 * _QUANTUM
        self.salt = seeds(tables, seed)

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own cells (n, tables) and probed cells (n, tables, 2**POINTS - 1)."""
        n = x.shape[0]
        whole = np.rint(x / np.sqrt((x * x).sum(axis=1, keepdims=True)) * _QUANTUM)
        y = (whole @ self.projection / self.width).reshape(-1, DIMS8)  # sums of integers: exact in any order
        y = np.rint(y * _QUANTUM) / _QUANTUM
        own = nearest_point(y)
        side = own + _ROOTS[((y - own) @ _ROOTS.T).argmax(axis=1)]
        shape = (n, self.tables, POINTS)
        pair = np.stack([_hash(own).reshape(shape), _hash(side).reshape(shape)])
        cells = np.zeros((n, self.tables, 1 << POINTS), U)
        for m in range(1 << POINTS):
            for p in range(POINTS):
                cells[:, :, m] += pair[m >> p & 1][:, :, p] * _POINT_KEY[p]
        cells = mix(cells + self.salt[None, :, None]).view(np.int64)
        return cells[:, :, 0], cells[:, :, 1:]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


_LINKS = "rep long, n_links long, root long"


def _compare(lattice, similarity: float, dims: int):
    """Links among one block (left only) or between two, for rows sorted by task."""

    def links(ids, x, right):
        norm = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        left = np.flatnonzero(~right)
        other = np.flatnonzero(right)
        within = not other.size
        found = []
        for i in range(0, left.size, 512):
            rows = left[i : i + 512]
            cols = left if within else other
            a, b = np.nonzero(norm[rows] @ norm[cols].T >= similarity - 1e-12)
            a, b = rows[a], cols[b]
            keep = ids[a] < ids[b] if within else ids[a] != ids[b]
            found.append((a[keep], b[keep]))
        a, b = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.empty(0, int),) * 2
        if not a.size:
            return None
        cosine = (x[a] * x[b]).sum(axis=1) / (np.sqrt((x[a] ** 2).sum(axis=1)) * np.sqrt((x[b] ** 2).sum(axis=1)))
        a, b = a[cosine >= similarity], b[cosine >= similarity]
        return (a, b) if a.size else None

    def owned(task, kind, ids, x, a, b):
        """Of the pairs found in cell ``task``, those that meet nowhere earlier."""
        keep = np.zeros(a.size, bool)
        some, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        home, probes = lattice.codes(x[some])
        for i in range(0, a.size, 4096):
            s = slice(i, i + 4096)
            p, q = at[: a.size][s], at[a.size :][s]
            swap = ids[some[p]] > ids[some[q]]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            meets = np.stack([
                home[p] == home[q],
                (probes[q] == home[p][:, :, None]).any(axis=2),  # the larger id probes the smaller one's cell
                (probes[p] == home[q][:, :, None]).any(axis=2),
            ], axis=2).reshape(p.size, -1)
            first = meets.argmax(axis=1)
            table, way = first // 3, first % 3
            cell = np.where(way == 1, home[p, table], home[q, table])
            # In this cell the pair is found once: among its own, or by the side that probes.
            mine = cell == task
            if kind == 0:
                mine &= way == 0
            else:  # left stands here, right probes
                stands = np.where(way == 1, ids[some[p]], ids[some[q]])
                mine &= (way != 0) & (ids[a[s]] == stands)
            keep[s] = mine
        return keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group(table: pa.Table):
            ids, count = table.column("rep").to_numpy(), table.column("n").to_numpy()
            right = table.column("probing").to_numpy()
            kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
            # One block against itself, or two sides of which one may be empty.
            if table.num_rows < 2 or right.all() or (not right.any() and not (kind == 0 and i == j)):
                return None
            x = matrix(table.column("embedding"), dims)
            found = links(ids, x, right)
            if found is None:
                return None
            a, b = found
            mine = owned(table.column("cell")[0].as_py(), kind, ids, x, a, b)
            n_links = np.zeros(ids.size, np.int64)
            np.add.at(n_links, a[mine], count[b[mine]])
            np.add.at(n_links, b[mine], count[a[mine]])
            order = np.argsort(ids, kind="stable")  # the smallest id is the root
            place = np.empty_like(order)
            place[order] = np.arange(order.size)
            root = ids[order][_forest(ids.size, place[a], place[b])][place]
            use = np.unique(np.concatenate([a, b]))
            return pa.RecordBatch.from_arrays([pa.array(ids[use]), pa.array(n_links[use]), pa.array(root[use])], names=["rep", "n_links", "root"])

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cut = np.append(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, batch.num_rows)
            at = 0
            for end in cut.tolist():
                if end == at:
                    continue
                key = tuple(keys[at])
                if held and key != last:
                    if (out := group(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(batch.slice(at, end - at))
                last, at = key, end
        if held and (out := group(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def embedding_groups(
    vectors: DataFrame, similarity: float = 0.95, tables: int = TABLES, block_rows: int = BLOCK, seed: int = 3
) -> DataFrame:
    """Links of cosine ``similarity`` or more: ``vec_id, n_links, component_id, kept`` for each vec_id.

    Vectors that take no part (see ``usable``) are rows of their own with no links, kept. Rows that repeat an
    id count once. A null id is one row of null id, linked with nothing, kept. Other columns are not read;
    an empty table gives no rows. Links are found with high probability, and every one returned is verified.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    base, dims = usable(vectors)
    lattice = Lattice(dims, similarity, tables, seed)
    digests = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    members = written(base.select("vec_id", *digests, "embedding"), "vectors")
    # A table of its own, so that the joins with it can split a digest that very many copies share.
    classes = written(members.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "classes")
    reps = written(members.select(F.col("vec_id").alias("rep"), "embedding").join(classes.select("rep", "n"), "rep"), "representatives")
    belongs = members.select("vec_id", "h1", "h2").join(classes, ["h1", "h2"]).select("vec_id", "rep", "n")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, probes = lattice.codes(matrix(b.column(1), dims))
            cells = np.concatenate([home, probes.reshape(home.shape[0], -1)], axis=1)
            probing = np.arange(cells.shape[1]) >= home.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(0).to_numpy(), cells.shape[1])), pa.array(cells.ravel()), pa.array(np.tile(probing, cells.shape[0]))],
                names=["rep", "cell", "probing"])

    entries = written(reps.select("rep", "embedding").mapInArrow(place, "rep long, cell long, probing boolean"), "cells")
    met = entries.groupBy("cell").agg(F.count_if(~F.col("probing")).alias("stand"), F.count_if("probing").alias("probe"))
    met = met.where("stand > 0 and stand + probe > 1")
    met = met.select("cell", "stand", "probe", F.ceil(F.col("stand") / block_rows).cast("int").alias("ns"), F.ceil(F.col("probe") / block_rows).cast("int").alias("np"))
    use = entries.join(met, "cell")
    # Tasks (cell, kind, i, j): kind 0 compares blocks i <= j of those that stand there, kind 1 block i of them with block j of those that probe.
    mine = F.pmod(F.xxhash64("rep"), F.greatest(F.when(F.col("probing"), F.col("np")).otherwise(F.col("ns")), F.lit(1))).cast("int")
    use = use.withColumn("mine", mine)
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    task = lambda kind, i, j, right: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), right.alias("probing"))
    none = F.array().cast("array<struct<kind:int,i:int,j:int,probing:boolean>>")
    same = F.when((F.col("stand") > 1), F.transform(upto(F.col("ns")), lambda o: task(0, F.least(o, F.col("mine")), F.greatest(o, F.col("mine")), o < F.col("mine")))).otherwise(none)
    crossed = F.when(F.col("probe") > 0, F.transform(upto(F.greatest(F.col("np"), F.lit(1))), lambda o: task(1, F.col("mine"), o, F.lit(False)))).otherwise(none)
    asked = F.transform(upto(F.col("ns")), lambda o: task(1, o, F.col("mine"), F.lit(True)))
    use = use.withColumn("task", F.explode(F.when(F.col("probing"), asked).otherwise(F.concat(same, crossed))))
    use = use.select("rep", "cell", "task.*").join(reps, "rep")
    use = use.select("cell", "kind", "i", "j", "rep", "n", "probing", "embedding")
    use = use.repartition("cell", "kind", "i", "j").sortWithinPartitions("cell", "kind", "i", "j", "probing", "rep")
    found = written(use.mapInArrow(_compare(lattice, similarity, dims), _LINKS), "links")
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "groups")
    counts = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    told = written(counts.join(groups.withColumnRenamed("node", "rep"), "rep", "left"), "told")
    out = belongs.join(told, "rep", "left")
    out = out.select(
        "vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    alone = ids.join(out.select("vec_id"), "vec_id", "left_anti")
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
