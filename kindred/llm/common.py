"""Shared plumbing of the training-data operators: Arrow batches, filters, components; tables are written by ``sources.stage``."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.stage import finished, written

__all__ = ["bounded_batches", "components", "finished", "lower_ascii", "read_table", "roughly_among", "tidied", "written"]

#: ASCII white space as the contracts define it: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bounds of one Arrow batch sent to a Python worker; very long texts travel in small batches.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def tidied() -> None:
    """Gives back what earlier tasks left in a reused Python worker. Called where a task begins."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library of another kind
        ctypes.CDLL(None).malloc_trim(0)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by rows and bytes, unless the session already states a bound."""
    for key, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """A-Z lower-cased, all else untouched. Pure ASCII values take the fast built-in."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def roughly_among(rows: DataFrame, ids: DataFrame, key: str, most_bits: int = 1 << 27) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the written ``ids``, before anything is shuffled.

    A bitmap of hashed ids, of 16 bits an id and ``most_bits`` (16 MB) at most, is broadcast. Hash collisions let
    rows through, more of them the fuller the bitmap; a row whose key is among the ids always stays.
    """
    bits = max(1 << 16, min(most_bits, 1 << (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64(key), F.lit(bits).cast("long"))
    part, place = F.shiftright(at, 15), at.bitwiseAND(F.lit((1 << 15) - 1))
    maps = ids.select(part.alias("part"), place.alias("place")).repartition("part")  # else every task would send whole bitmaps
    maps = maps.groupBy("part").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (place.bitwiseAND(F.lit(7)) + 1).cast("int"))) != 0
    return rows.join(F.broadcast(maps), (part == F.col("part")) & hit, "left_semi")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge, to a node that is no larger end itself."""
    if edges.groupBy("a").count().where("count > 1").limit(1).count():
        return False
    return not edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: rows ``(node, component)``.

    Alternating large-star and small-star steps (Kiveris et al., 2014) with every round's edges
    written to the shared folder. Rows: every node on some edge, with its component's smallest id.
    A hot node only ever meets its edges through a partial aggregate and a join with a table of least
    neighbours, which adaptive execution can split. Self-loops and null ends are ignored; no edges give no rows.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{label}-0",
    )
    step = 0
    while not _all_stars(edges):
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = written(least, f"{label}-{step}-large")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), f"{label}-{step}-stars")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-{step}-small")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = written(
            small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{label}-{step}"
        )
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
