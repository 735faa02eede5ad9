"""Validation of match and candidate tables. Every check yields rows of one violations frame; none collects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.operators.pairs import repeated

S1, MATCHES, CANDIDATES = "source1_entity_id", "matched_entity_ids", "candidate_entity_ids"


def _rows(df: DataFrame, file: str, code: str, key, detail) -> DataFrame:
    return df.select(F.lit(file).alias("file"), F.lit(code).alias("code"), F.col(key).alias("s1_id"), detail.cast("string").alias("detail"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def raw_ids(col: str):
    """Ids of a comma list as they stand; none for an empty one."""
    return F.when(F.coalesce(F.col(col), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(col, ","))


def _codes(**when) -> Column:
    """The codes whose conditions hold, each with its detail: ``code=(condition, detail)``."""
    found = [F.when(c, F.struct(F.lit(code).alias("code"), d.cast("string").alias("detail"))) for code, (c, d) in when.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def table_violations(table: DataFrame, column: str, file: str, s1: DataFrame, targets: DataFrame | None) -> DataFrame:
    """Rules of one output table: id shape, repeats, list contents, coverage of S1 and known targets.

    Two passes: one over the rows, grouped by their id and met with S1, and one over the distinct listed ids.
    """
    none = F.lit(None)
    rows = table.groupBy(S1).agg(F.count("*").alias("n"))
    known = s1.select(F.col("entity_id").alias("known")).distinct()
    rows = rows.join(known, F.col(S1) == F.col("known"), "full_outer")
    here, empty = F.col("n").isNotNull(), F.coalesce(F.col(S1), F.lit("")) == ""
    per_id = _codes(
        duplicate_s1=(F.col("n") > 1, F.col("n")), missing_s1=(~here, none), extra_s1=(here & F.col("known").isNull(), none))
    # These two count every row.
    per_row = _codes(empty_s1=(here & empty, none), bad_s1_prefix=(here & ~empty & ~F.col(S1).startswith("S1-"), none))
    per_row = F.flatten(F.transform(per_row, lambda x: F.array_repeat(x, F.col("n").cast("int"))))
    out = rows.select(F.coalesce(S1, "known").alias("s1_id"), F.explode(F.concat(per_id, per_row)).alias("x"))

    listed = table.select(S1, F.explode(raw_ids(column)).alias("id")).groupBy(S1, "id").agg(F.count("*").alias("n"))
    own, fine = F.col("id").startswith("S1-"), F.col("id").rlike("^S[23]-.+$")
    when = {"duplicate_listed_id": (F.col("n") > 1, F.col("id")), "self_match": (own, F.col("id")), "bad_listed_prefix": (~own & ~fine, F.col("id"))}
    if targets is not None:
        held = targets.select(F.col("entity_id").alias("held")).distinct()
        listed = listed.join(held, F.col("id") == F.col("held"), "left")
        when["unknown_target"] = (fine & F.col("held").isNull(), F.col("id"))
    out = out.unionByName(listed.select(F.col(S1).alias("s1_id"), F.explode(_codes(**when)).alias("x")))
    return out.select(F.lit(file).alias("file"), "x.code", "s1_id", "x.detail")


def subset_violations(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Listed matches that are not among the candidates of their S1 record."""
    m = matches.select(S1, F.explode(text.id_list(MATCHES)).alias("id")).distinct()
    c = candidates.select(S1, F.explode(text.id_list(CANDIDATES)).alias("id")).distinct()
    return _rows(m.join(c, [S1, "id"], "left_anti"), "matching", "match_not_candidate", S1, F.col("id"))


def violations(matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """All violations of the internal rules: ``file, code, s1_id, detail``."""
    return _union([
        table_violations(matches, MATCHES, "matching", s1, targets),
        table_violations(candidates, CANDIDATES, "candidates", s1, targets), subset_violations(matches, candidates)])


def official(matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame | None = None, strict_subset: bool = False) -> DataFrame:
    """Per rule: severity, how many violations, and five examples at most, in order.

    A match outside the candidates is a warning, an error with ``strict_subset``.
    """
    found = violations(matches, candidates, s1, targets)
    soft = (F.col("code") == "match_not_candidate") & F.lit(not strict_subset)
    shown = F.coalesce("detail", "s1_id")
    turn = Window.partitionBy("file", "code").orderBy(shown)
    few = found.withColumn("shown", shown).select("file", "code", "shown").distinct()
    few = few.withColumn("turn", F.row_number().over(Window.partitionBy("file", "code").orderBy("shown"))).where("turn <= 5")
    few = few.groupBy("file", "code").agg(F.array_join(F.sort_array(F.collect_list("shown")), ", ").alias("examples"))
    totals = found.groupBy("file", "code").agg(F.count("*").alias("n"))
    return totals.join(few, ["file", "code"], "left").select(
        F.when(soft, "warning").otherwise("error").alias("severity"), "file", "code", "n", "examples")


def lockstep(s1: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Positions at which the three tables, each with ``row_idx``, do not hold the same id."""
    side = lambda d, c, name: d.select("row_idx", F.col(c).alias(name))
    out = side(s1, "entity_id", "s1_id").join(side(matches, S1, "match_id"), "row_idx", "full_outer").join(side(candidates, S1, "candidate_row_id"), "row_idx", "full_outer")
    same = F.col("s1_id").eqNullSafe(F.col("match_id")) & F.col("s1_id").eqNullSafe(F.col("candidate_row_id"))
    return out.where(~same)


def unknown_targets(candidates: DataFrame, targets: DataFrame) -> DataFrame:
    listed = candidates.select(F.explode(text.id_list(CANDIDATES)).alias("entity_id")).distinct()
    return listed.join(targets.select("entity_id"), "entity_id", "left_anti")


def run_totals(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Totals of a run: rows, pairs, links, entities without matches and without candidates, average candidates."""
    m = matches.select(S1, F.size(text.id_list(MATCHES)).alias("m"))
    c = candidates.select(S1, F.size(text.id_list(CANDIDATES)).alias("c"))
    return m.join(c, S1).agg(
        F.count("*").alias("source1_rows"), F.sum("c").alias("candidate_pairs"), F.sum("m").alias("predicted_links"),
        F.count_if(F.col("m") == 0).alias("zero_matches"), F.count_if(F.col("c") == 0).alias("zero_candidates"), F.avg("c").alias("average_candidates"))


def require_none(found: DataFrame, what: str) -> None:
    """Raise with up to five examples if ``found`` has rows."""
    rows = found.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def contract_violations(pairs: DataFrame) -> DataFrame:
    """Rules of a labelled pair table: ids present, S2 or S3 candidates, labels 0 or 1, no pair twice."""
    bad = lambda code, df: df.select(F.lit(code).alias("code"), "s1_id", "candidate_id")
    parts = [
        bad("null_id", pairs.where("s1_id is null or candidate_id is null")),
        bad("bad_prefix", pairs.where(~F.col("candidate_id").rlike("^S[23]-"))),
        bad("duplicate_pair", repeated(pairs, "s1_id", "candidate_id")),
    ]
    if "label" in pairs.columns:
        parts.append(bad("bad_label", pairs.where("label is null or label not in (0, 1)")))
    return _union(parts)
