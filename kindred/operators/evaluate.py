"""Metrics of candidates and predictions. Entities, not pairs, are the denominator; those without pairs count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.functions.fuzzy import entity_f_half
from kindred.operators.pairs import exploded_truth

QUANTILES = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95)


def entity_counts(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per entity of ``truth``: ``tp, n_pred, n_true`` from id lists; entities without a prediction row predict nothing."""
    t = truth.select("source1_entity_id", text.id_list("matched_entity_ids").alias("t"))
    p = predicted.select("source1_entity_id", text.id_list("matched_entity_ids").alias("p"))
    both = t.join(p, "source1_entity_id", "left").withColumn("p", F.coalesce("p", F.array().cast("array<string>")))
    return both.select("source1_entity_id", F.size(F.array_intersect("t", "p")).alias("tp"), F.size("p").alias("n_pred"), F.size("t").alias("n_true"))


def entity_f05(counts: DataFrame) -> DataFrame:
    return counts.withColumn("f0_5", entity_f_half(F.col("tp"), F.col("n_pred"), F.col("n_true")))


def macro_f05(counts: DataFrame) -> DataFrame:
    return entity_f05(counts).agg(F.round(F.avg("f0_5"), 9).alias("macro_f0_5"), F.count("*").alias("entities"))


def micro(counts: DataFrame) -> DataFrame:
    """Pooled precision and recall; 0 where a denominator is 0."""
    tp, p, t = F.sum("tp"), F.sum("n_pred"), F.sum("n_true")
    part = lambda n: F.when(n > 0, tp / n).otherwise(0.0)
    return counts.agg(part(p).alias("precision"), part(t).alias("recall"), tp.alias("true_positives"))


def found_pairs(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """True pairs with ``found``: whether the candidates hold them."""
    have = candidates.select("s1_id", "candidate_id").distinct().withColumn("found", F.lit(True))
    return exploded_truth(truth).join(have, ["s1_id", "candidate_id"], "left").fillna(False, ["found"])


def blocking_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Overall recall, null where nothing is true."""
    return found_pairs(truth, candidates).agg(
        F.avg(F.col("found").cast("double")).alias("recall"), F.count("*").alias("true_pairs"),
        F.count_if("found").alias("found_pairs"), F.count_if(~F.col("found")).alias("missed_pairs"))


def recall_by_source(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    return found_pairs(truth, candidates).groupBy(text.id_source("candidate_id").alias("source")).agg(
        F.avg(F.col("found").cast("double")).alias("recall"), F.count("*").alias("true_pairs"))


def candidate_density(universe: DataFrame, candidates: DataFrame) -> DataFrame:
    """Mean, median and most candidates per entity over all of ``universe``, and how many have none."""
    n = candidates.select("s1_id", "candidate_id").distinct().groupBy("s1_id").agg(F.count("*").alias("n"))
    per = universe.select(F.col("entity_id").alias("s1_id")).join(n, "s1_id", "left").fillna(0, ["n"])
    return per.agg(F.avg("n").alias("mean"), F.median("n").alias("median"), F.max("n").alias("max"), F.count_if(F.col("n") == 0).alias("zero"))


def entity_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Link, any-match and complete recall over entities with a true match."""
    per = found_pairs(truth, candidates).groupBy("s1_id").agg(F.count_if("found").alias("tp"), F.count("*").alias("n"))
    share = lambda c: F.avg(c.cast("double"))
    return per.agg(
        (F.sum("tp") / F.sum("n")).alias("link_recall"), share(F.col("tp") > 0).alias("any_recall"),
        share(F.col("tp") == F.col("n")).alias("complete_recall"), F.count("*").alias("entities"))


def oracle_ceiling(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Macro F0.5 of predicting exactly the true pairs among the candidates."""
    got = found_pairs(truth, candidates).groupBy("s1_id").agg(F.count_if("found").alias("tp"), F.count("*").alias("n_true"))
    ids = truth.select(F.col("source1_entity_id").alias("s1_id")).distinct()
    counts = ids.join(got, "s1_id", "left").fillna(0, ["tp", "n_true"]).withColumn("n_pred", F.col("tp"))
    return macro_f05(counts)


def missed_pairs(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    return exploded_truth(truth).join(candidates.select("s1_id", "candidate_id"), ["s1_id", "candidate_id"], "left_anti")


def quantiles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact interpolated quantiles, one row per column and quantile."""
    levels = F.array(*(F.lit(q) for q in QUANTILES))
    one = df.agg(*(F.percentile(c, levels).alias(c) for c in columns))

    def of(c: str):
        at = F.sequence(F.lit(0), F.lit(len(QUANTILES) - 1))
        return F.transform(at, lambda i: F.struct(F.lit(c).alias("feature"), levels[i].alias("quantile"), F.col(c)[i].alias("value")))

    return one.select(F.explode(F.concat(*map(of, columns))).alias("r")).select("r.*")


def threshold_coverage(df: DataFrame, name: str, address: str, percents: list[int]) -> DataFrame:
    """Share of rows whose name, address, or either reaches each threshold."""
    grid = F.array(*(F.lit(p) for p in percents))
    out = df.withColumn("percent", F.explode(grid)).withColumn("t", F.col("percent") / 100)
    x, y = F.col(name) >= F.col("t"), F.col(address) >= F.col("t")
    share = lambda c: F.avg(c.cast("double"))
    return out.groupBy("percent").agg(share(x).alias("name_coverage"), share(y).alias("address_coverage"), share(x | y).alias("either_coverage"))


def threshold_sweep(scored: DataFrame, truth: DataFrame, percents: list[int]) -> DataFrame:
    """``percent, macro_f0_5`` in one pass: every pair falls into the grid once and counts accumulate downwards.

    scored: ``s1_id, candidate_id, match_probability``, pairs distinct. Thresholds are percent / 100, inclusive; every entity
    of ``truth`` counts. Entities meet the grid only through a bounded array of it.
    """
    grid = sorted(set(percents))
    levels = F.array(*(F.lit(p) for p in grid))
    true = exploded_truth(truth)
    marked = scored.select("s1_id", "candidate_id", "match_probability").join(true.withColumn("hit", F.lit(1)), ["s1_id", "candidate_id"], "left")
    passed = F.size(F.filter(levels, lambda p: F.col("match_probability") >= p / 100)).alias("passed")
    steps = marked.select("s1_id", passed, F.coalesce("hit", F.lit(0)).alias("hit")).groupBy("s1_id", "passed").agg(F.count("*").alias("n"), F.sum("hit").alias("tp"))
    per = steps.groupBy("s1_id").agg(F.collect_list(F.struct("passed", "n", "tp")).alias("steps"))  # at most a grid's length
    n_true = true.groupBy("s1_id").agg(F.count("*").alias("n_true"))
    ids = truth.select(F.col("source1_entity_id").alias("s1_id")).distinct()
    all_ids = ids.join(per, "s1_id", "left").join(n_true, "s1_id", "left").fillna(0, ["n_true"])
    none = F.array().cast("array<struct<passed:int,n:bigint,tp:bigint>>")
    rows = all_ids.select(F.coalesce("steps", none).alias("steps"), "n_true", F.posexplode(levels).alias("at", "percent"))
    total = lambda field: F.aggregate(F.filter("steps", lambda s: s["passed"] > F.col("at")), F.lit(0).cast("long"), lambda acc, s: acc + s[field])
    counts = rows.select("percent", total("tp").alias("tp"), total("n").alias("n_pred"), "n_true")
    return entity_f05(counts).groupBy("percent").agg(F.round(F.avg("f0_5"), 9).alias("macro_f0_5"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The best row of a sweep, ties to the larger threshold."""
    best = F.max(F.struct("macro_f0_5", "percent")).alias("b")
    return curve.agg(best).select("b.percent", "b.macro_f0_5")
