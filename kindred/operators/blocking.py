"""Exact-key candidate generation.

Records: ``entity_id, name, address, country`` with normalized texts; ``source`` on targets is the id's prefix.
Every join carries the country. A capped join keeps the smallest targets of each key *before* the
join, so a hot key never fans out beyond its cap; the kept rows depend on the targets alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.sources.stage import written

#: Query kinds of the capped lookup: compared columns, and the order in which a cap keeps targets.
KINDS = {
    "name_address": (["name", "address"], ["entity_id"]),
    "name": (["name"], ["address", "entity_id"]),
    "address": (["address"], ["name", "entity_id"]),
}


def targets(*sources: DataFrame) -> DataFrame:
    """Union of target sources, with ``source`` from the id."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out.withColumn("source", text.id_source("entity_id"))


def _left(s1: DataFrame, keys: list[str]) -> DataFrame:
    return s1.select(F.col("entity_id").alias("s1_id"), "country", *keys)


def exact_name(s1: DataFrame, others: DataFrame) -> DataFrame:
    """(s1_id, candidate_id, score 1.0) of equal non-empty names within a country."""
    right = others.select(F.col("entity_id").alias("candidate_id"), "country", "name").where("name <> ''")
    return _left(s1, ["name"]).join(right, ["country", "name"]).select("s1_id", "candidate_id", F.lit(1.0).alias("score"))


def exact_capped(s1: DataFrame, others: DataFrame, limit: int = 512) -> DataFrame:
    """(s1_id, kind, source, candidate_id) for each query kind, at most ``limit`` per S1, kind and source."""
    out = None
    for kind, (keys, order) in KINDS.items():
        filled = " and ".join(f"{k} <> ''" for k in keys)
        turn = Window.partitionBy("country", "source", *keys).orderBy(*order)
        kept = others.where(filled).withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= limit)
        kept = kept.select("country", "source", *keys, F.col("entity_id").alias("candidate_id"))
        part = _left(s1, keys).join(kept, ["country", *keys])
        part = part.select("s1_id", F.lit(kind).alias("kind"), "source", "candidate_id")
        out = part if out is None else out.unionByName(part)
    return out


def exact_overflow(s1: DataFrame, others: DataFrame, limit: int = 512) -> DataFrame:
    """Per kind and source: S1 probes that meet more than ``limit`` targets."""
    out = None
    for kind, (keys, _) in KINDS.items():
        filled = " and ".join(f"{k} <> ''" for k in keys)
        full = others.where(filled).groupBy("country", "source", *keys).count().where(F.col("count") > limit)
        part = _left(s1, keys).join(full, ["country", *keys]).groupBy("source").agg(F.count("*").alias("overflow"))
        part = part.select(F.lit(kind).alias("kind"), "source", "overflow")
        out = part if out is None else out.unionByName(part)
    return out


#: How many ids a block holds at most (whole eights of ids repeat from byte to byte where Parquet packs them), how many a tile, about, and
#: how many pairs a task lists, about.
BLOCK, TILE, TASK = 128, 2048, 1 << 24


def exact_methods(s1: DataFrame, others: DataFrame) -> DataFrame:
    """Uncapped probes by name and by address, merged: (s1_id, candidate_id, retrieval_method).

    Blocks meet, not records: a block lists ids of one name and address, so its pairs with another block have one method. Those of
    hot keys are dealt to tiles, and each pair of tiles to a task. Pairs come block by block, few ids at a time, which
    Parquet stores in a small part of the room. A pair of records with an id of their own is made once, by its name or else by its
    address, so nothing is grouped; only pairs with an id that several records of a side share are.
    """
    spark = s1.sparkSession
    left, right = _blocks(s1, "s1"), _blocks(others, "targets")
    plain, again = [], []
    for key in ("name", "address"):
        count = lambda df, n: df.where(F.col(key) != "").groupBy("country", key).agg(F.sum(F.size("ids")).alias(n))  # noqa: B023, E731
        hot = written(count(left, "s1").join(count(right, "targets"), ["country", key]), f"exact-{key}-counts")
        made = hot.agg(F.sum(F.col("s1").cast("double") * F.col("targets"))).first()[0] or 0
        tasks = min(int(made / TASK) + 1, 20_000)
        tasks = tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else 0
        here, there = _tiles(left, hot, key, "s1", "targets"), _tiles(right, hot, key, "targets", "s1")
        plain.append(_listed(here.where("not several"), there.where("not several"), key, tasks))
        again += [_listed(here.where("several"), there, key, tasks), _listed(here.where("not several"), there.where("several"), key, tasks)]
    again = again[0].unionByName(again[1]).unionByName(again[2]).unionByName(again[3])
    again = again.select("s1_id", "candidate_id", F.explode(F.split("retrieval_method", "[+]")).alias("method"))
    methods = F.array_join(F.sort_array(F.collect_set("method")), "+").alias("retrieval_method")
    return plain[0].unionByName(plain[1]).unionByName(again.groupBy("s1_id", "candidate_id").agg(methods))


def _blocks(df: DataFrame, label: str) -> DataFrame:
    """(country, name, address, several, block, ids): records that a probe can meet, up to ``BLOCK`` of one name and address in a row.

    ``several``: their ids are those of other records too.
    """
    of = ["country", "name", "address", "several"]
    shared = F.count("*").over(Window.partitionBy("entity_id")) > 1
    filled = df.select("entity_id", "country", *(F.coalesce(c, F.lit("")).alias(c) for c in ("name", "address")))
    rows = written(filled.where("country is not null and (name <> '' or address <> '')").withColumn("several", shared), f"exact-{label}")
    # The ids of a name and address are gathered in parts, so that no list grows beyond a tile or so.
    large = rows.groupBy(*of).agg(F.count("*").alias("n")).where(F.col("n") > TILE)
    part = F.coalesce(F.pmod(F.xxhash64("entity_id"), F.ceil(F.col("n") / TILE)), F.lit(0)).alias("part")
    parts = rows.join(large, of, "left").select(*of, part, "entity_id").groupBy(*of, "part").agg(F.collect_list("entity_id").alias("all"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(BLOCK))
    blocks = parts.select(*of, "part", "all", F.explode(starts).alias("start"))
    return written(blocks.select(*of, F.xxhash64("part", "start").alias("block"), F.slice("all", F.col("start"), BLOCK).alias("ids")), f"exact-{label}-blocks")


def _tiles(blocks: DataFrame, hot: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """Blocks whose key the other side has too, each in a tile of its own side and once for each tile of the other: ``tile_<side>``."""
    tiles = lambda side: F.ceil(F.col(side) / TILE)
    out = blocks.where(F.col(key) != "").join(hot, ["country", key])
    out = out.withColumn(f"tile_{own}", F.pmod(F.xxhash64("name", "address", "several", "block"), tiles(own)))
    out = out.withColumn(f"tile_{other}", F.explode(F.sequence(F.lit(0).cast("long"), tiles(other) - 1)))
    return out.select("country", "name", "address", "several", "ids", "tile_s1", "tile_targets")


def _listed(left: DataFrame, right: DataFrame, key: str, tasks: int) -> DataFrame:
    """The pairs of blocks of one key, listed; by address without those of one name. tasks: 0 for those of the session."""
    on = ["country", key, "tile_s1", "tile_targets"]
    if tasks:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    a, b = left.alias("a"), right.alias("b")
    met = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    if key == "name":
        method = F.when((F.col("a.address") == F.col("b.address")) & (F.col("a.address") != ""), "exact_address+exact_name").otherwise("exact_name")
    else:
        met.append((F.col("a.name") != F.col("b.name")) | (F.col("a.name") == ""))
        method = F.lit("exact_address")
    pairs = a.join(b, met).select(F.col("a.ids").alias("s1_ids"), F.col("b.ids").alias("ids"), method.alias("retrieval_method"))
    pairs = pairs.select(F.explode("s1_ids").alias("s1_id"), "ids", "retrieval_method")
    return pairs.select("s1_id", F.explode("ids").alias("candidate_id"), "retrieval_method")


def first_per_pair(candidates: DataFrame) -> DataFrame:
    """One row per (s1_id, candidate_id): exact methods first, then the best score."""
    best = Window.partitionBy("s1_id", "candidate_id").orderBy(
        F.col("retrieval_method").startswith("exact").desc(), F.desc("score"), "retrieval_method")
    return candidates.withColumn("turn", F.row_number().over(best)).where("turn = 1").drop("turn")
