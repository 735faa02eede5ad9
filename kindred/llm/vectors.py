"""What the vector operators share: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, dims: int | None = None) -> tuple[DataFrame, int]:
    """(vec_id, embedding array<double>) of the vectors that take part, one row per id, and their length.

    Out: null ids; null, empty or zero vectors; null or non-finite components; lengths other than ``dims``
    (by default the most frequent length). Rows that repeat an id count once, as the smallest vector.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    big = float("inf")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)
    v = v.where("vec_id is not null and embedding is not null")
    v = v.where(F.forall("embedding", fine)).where(F.exists("embedding", lambda x: x != 0))
    if dims is None:
        top = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dims = top["n"] if top else 1
    v = v.where(F.size("embedding") == dims)
    if v.groupBy("vec_id").count().where("count > 1").limit(1).count():
        v = v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return v, dims


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dims)


def lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(values.shape[0] + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
