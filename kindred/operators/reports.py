"""Profiles, country counts, and the experiment tracker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that a tracker must have.
TRACKER = ("experiment_id", "date", "git_commit", "branch", "model_name", "model_config", "feature_config", "candidate_config",
           "decision_threshold", "validation_f0_5", "validator_status", "submission_file", "candidate_file",
           "submission_number_for_day", "public_leaderboard_score", "private_leaderboard_score", "status", "notes")


def profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, and missing (null or empty) values per column: (table, column, rows, missing)."""
    gone = [F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")).alias(c) for c in df.columns]
    one = df.agg(F.count("*").alias("__rows"), *gone)
    item = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing")) for c in df.columns)))
    return one.select("__rows", item.alias("x")).select(F.lit(label).alias("table"), "x.column", F.col("__rows").alias("rows"), "x.missing")


def country_counts(df: DataFrame) -> DataFrame:
    """Records per country, null included, largest first."""
    return df.groupBy("country").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "country")


def country_map(df: DataFrame) -> DataFrame:
    """The counts as one map, for reports."""
    counts = df.groupBy("country").agg(F.count("*").alias("n"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("country", F.lit("")), "n")))).alias("countries"))


def is_submission():
    return (F.coalesce("submission_number_for_day", F.lit("")) != "") | (F.coalesce("submission_file", F.lit("")) != "")


def daily_submissions(tracker: DataFrame) -> DataFrame:
    return tracker.where(is_submission()).groupBy("date").agg(F.count("*").alias("submissions"))


def tracker_violations(tracker: DataFrame, per_day: int = 5) -> DataFrame:
    """(rule, experiment_id): repeated ids, over ``per_day`` submissions, bad or repeated numbers, missing fields, no PASS."""
    row = lambda rule, df: df.select(F.lit(rule).alias("rule"), "experiment_id")
    ids = tracker.groupBy("experiment_id").count().where("count > 1")
    sent = tracker.where(is_submission())
    number = F.col("submission_number_for_day").try_cast("int")
    full = sent.groupBy("date").count().where(F.col("count") > per_day)
    same = sent.groupBy("date", "submission_number_for_day").count().where("count > 1")
    required = ("experiment_id", "date", "model_name", "status")
    empty = [F.coalesce(c, F.lit("")) == "" for c in required]
    out = row("duplicate_id", ids)
    for rule, df in (
        ("too_many_on_day", sent.join(full, "date", "left_semi")),
        ("bad_number", sent.where(number.isNull() | ~number.between(1, per_day))),
        ("repeated_number", sent.join(same, ["date", "submission_number_for_day"], "left_semi")),
        ("missing_field", tracker.where(empty[0] | empty[1] | empty[2] | empty[3])),
        ("validator_not_passed", sent.where(F.upper(F.coalesce("validator_status", F.lit(""))) != "PASS")),
        ("missing_file_name", sent.where((F.coalesce("submission_file", F.lit("")) == "") | (F.coalesce("candidate_file", F.lit("")) == ""))),
    ):
        out = out.unionByName(row(rule, df))
    return out


def add_experiment(tracker: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new``, to be appended, if tracker and they together break no rule."""
    found = tracker_violations(tracker.select(*TRACKER).unionByName(new.select(*TRACKER))).limit(5).collect()
    if found:
        raise ValueError("; ".join(f"{r['rule']}: {r['experiment_id']}" for r in found))
    return new.select(*TRACKER)


def cross_agreement(run: dict, check: dict, keys=("source1_rows", "candidate_pairs", "predicted_links", "zero_matches", "zero_candidates")) -> list[str]:
    """Totals on which two reports differ."""
    return [k for k in keys if run.get(k) != check.get(k)]
