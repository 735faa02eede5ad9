"""Labels, id lists and set operations on pairs of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text


def exploded_truth(truth: DataFrame) -> DataFrame:
    """(s1_id, candidate_id) of ``source1_entity_id, matched_entity_ids``; empty lists have no rows."""
    ids = F.explode(text.id_list("matched_entity_ids")).alias("candidate_id")
    return truth.select(F.col("source1_entity_id").alias("s1_id"), ids).distinct()


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs`` with ``label``: 1 where the truth lists the pair. All other columns stay."""
    true = exploded_truth(truth).withColumn("label", F.lit(1))
    return pairs.join(true, ["s1_id", "candidate_id"], "left").fillna(0, ["label"])


def label_stats(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count("*").alias("total_pairs"), F.count_if(F.col("label") == 1).alias("positive_pairs"),
        F.count_if(F.col("label") == 0).alias("negative_pairs"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("positive_rate"))


def id_lists(pairs: DataFrame, universe: DataFrame, column: str = "matched_entity_ids", order: tuple = ("candidate_id",)) -> DataFrame:
    """One row per id of ``universe``: its distinct candidates by ``order``, joined by commas; empty where it has none.

    order: columns, a leading minus for descending numbers. The first occurrence of an id counts.
    """
    keys = [(-F.col(c[1:])) if c.startswith("-") else F.col(c) for c in order]
    item = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)), F.col("candidate_id").alias("id"))
    ids = F.array_distinct(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["id"]))
    lists = pairs.groupBy("s1_id").agg(F.array_join(ids, ",").alias(column))
    out = universe.select(F.col("entity_id").alias("s1_id")).join(lists, "s1_id", "left").fillna("", [column])
    return out.withColumnRenamed("s1_id", "source1_entity_id")


def select_matches(scored: DataFrame, universe: DataFrame, threshold: float) -> DataFrame:
    """Sorted ids with probability >= ``threshold`` for every id of ``universe``."""
    if not 0 <= threshold <= 1:
        raise ValueError(f"threshold must lie in [0, 1]: {threshold}")
    return id_lists(scored.where(F.col("match_probability") >= threshold), universe)


def best_n(ranked: DataFrame, n: int) -> DataFrame:
    turn = Window.partitionBy("source1_entity_id").orderBy("retrieval_rank", "candidate_entity_id")
    return ranked.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= n).drop("turn")


def submission(ranked: DataFrame, universe: DataFrame, n: int | None = None) -> DataFrame:
    """``source1_entity_id, candidate_entity_ids``, best score first, for all of ``universe``."""
    kept = ranked if n is None else best_n(ranked, n)
    pairs = kept.select(F.col("source1_entity_id").alias("s1_id"), F.col("candidate_entity_id").alias("candidate_id"), F.col("retrieval_rank"))
    return id_lists(pairs, universe, "candidate_entity_ids", ("retrieval_rank", "candidate_id"))


def of_ids(df: DataFrame, ids: DataFrame, column: str = "entity_id") -> DataFrame:
    """Rows of ``df`` whose id is among ``ids``."""
    return df.join(ids.select(column).distinct(), column, "left_semi")


def missing_and_extra(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Ids on one side alone: (id, side) with side missing (left only) or extra (right only)."""
    a, b = left.select(F.col(column).alias("id")).distinct(), right.select(F.col(column).alias("id")).distinct()
    gone, more = a.join(b, "id", "left_anti"), b.join(a, "id", "left_anti")
    return gone.withColumn("side", F.lit("missing")).unionByName(more.withColumn("side", F.lit("extra")))


def repeated(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")
