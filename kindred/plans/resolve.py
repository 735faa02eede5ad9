"""The engine's jobs: build an index, infer matches, validate them, and all of it in a row."""

from __future__ import annotations

import argparse
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.functions.features import FEATURES_16, features_16
from kindred.operators import blocking, evaluate, model, pairs, qa, rare, tfidf
from kindred.sources import tables

INDEX_VERSION = 1


def normalized(records: DataFrame) -> DataFrame:
    """(entity_id, name, address, country) with basic normalization; nulls become empty."""
    return records.select(
        "entity_id", text.normalize_basic("business_name").alias("name"), text.normalize_basic("business_address").alias("address"),
        F.coalesce("country", F.lit("")).alias("country"))


def build_index(spark: SparkSession, sources: list[DataFrame], path: str, cap: int = 24) -> dict:
    """Targets and postings as Parquet under ``path``, with metadata; an index of the same content is reused.

    An index of other content is refused, never overwritten.
    """
    raw = blocking.targets(*sources)
    mark = tables.fingerprint(raw).first().asDict()
    meta = {"version": INDEX_VERSION, "cap": cap, "fingerprint": {k: str(v) for k, v in mark.items()}}
    held = _metadata(spark, path)
    if held is not None:
        if held != meta:
            raise ValueError("the index was built from other records or with other settings")
        return held
    records = normalized(raw).withColumn("source", text.id_source("entity_id"))
    qa.require_none(qa.repeated(records, "entity_id"), "repeated target ids")
    records.write.mode("errorifexists").parquet(f"{path}/targets")
    stored = spark.read.parquet(f"{path}/targets")
    rare.postings(rare.grams(stored), cap).repartition("country", "kind", "gram").write.mode("errorifexists").parquet(f"{path}/postings")
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/metadata")
    return meta


def _metadata(spark: SparkSession, path: str) -> dict | None:
    from pyspark.errors import AnalysisException

    try:
        return json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    meta = _metadata(spark, path)
    if meta is None or meta["version"] != INDEX_VERSION:
        raise ValueError(f"no index of version {INDEX_VERSION} at {path}")
    found, index = spark.read.parquet(f"{path}/targets"), spark.read.parquet(f"{path}/postings")
    for df, need in ((found, {"entity_id", "name", "address", "country", "source"}), (index, {"country", "kind", "gram", "entity_id", "df"})):
        if need - set(df.columns):
            raise ValueError(f"the index lacks columns {sorted(need - set(df.columns))}")
    return found, index


def scored_candidates(s1: DataFrame, found: DataFrame, index: DataFrame, classifier: PipelineModel, **options) -> DataFrame:
    """Candidates of raw S1 records with their features and probability."""
    records = normalized(s1)
    got = rare.production_candidates(records, found, index, **options).select("s1_id", "candidate_id")
    both = rare.with_texts(got, records, found)
    both = both.withColumnsRenamed({f"{p}_{c}": f"{p}_business_{c}" for p in ("s1", "candidate") for c in ("name", "address")})
    return model.score(classifier, features_16(both, normalized=True))


def infer(s1: DataFrame, found: DataFrame, index: DataFrame, classifier: PipelineModel, threshold: float = 0.56, **options) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) with one row per S1 record each, the empty ones included."""
    scored = scored_candidates(s1, found, index, classifier, **options)
    return pairs.select_matches(scored, s1, threshold), pairs.id_lists(scored, s1, "candidate_entity_ids")


def validate(matches: DataFrame, candidates: DataFrame, s1: DataFrame, found: DataFrame, expected_rows: int | None = None) -> dict:
    """Strict checks; raises on any violation, returns the totals otherwise. Tables that carry ``row_idx`` must hold the same ids row by row."""
    qa.require_none(qa.violations(matches, candidates, s1, found), "violations")
    if all("row_idx" in t.columns for t in (matches, candidates, s1)):
        qa.require_none(qa.lockstep(s1, matches, candidates), "rows out of step")
    totals = qa.run_totals(matches, candidates).first().asDict()
    if expected_rows is not None and totals["source1_rows"] != expected_rows:
        raise ValueError(f"expected {expected_rows} rows, found {totals['source1_rows']}")
    countries = {r["country"]: r["n"] for r in s1.groupBy("country").agg(F.count("*").alias("n")).collect()}
    return {"passed": True, **totals, "countries": countries}


def official(spark: SparkSession, data: str, output: str, index: str) -> DataFrame:
    """Official rules over stored outputs as one distributed job; a match outside the candidates is an error."""
    matches = tables.read_tsv(spark, f"{output}/matching_results", tables.MATCHING)
    candidates = tables.read_tsv(spark, f"{output}/candidate_pairs", tables.CANDIDATES)
    return qa.official(matches, candidates, tables.read_records(spark, f"{data}/source1.tsv", "S1-"), load_index(spark, index)[0], strict_subset=True)


def run(spark: SparkSession, data: str, index: str, output: str, classifier: PipelineModel | None, threshold: float = 0.56, stage: str = "run", model_path: str | None = None, **options) -> dict:
    """``index``, ``infer``, ``validate`` or all (``run``) over source1.tsv, source2.tsv and source3.tsv in ``data``.

    Inference leaves its provenance (code, and the model's files where ``model_path`` names them) beside its outputs, and fails if
    it changed meanwhile; validation fails if it is another one.
    """
    read = lambda i: tables.read_records(spark, f"{data}/source{i}.tsv", f"S{i}-")
    mark = lambda: tables.provenance(spark, **({"model": model_path} if model_path else {}))
    report: dict = {}
    if stage in ("index", "run"):
        report["index"] = build_index(spark, [read(2), read(3)], index)
    if stage in ("infer", "run"):
        before = mark()
        found, postings = load_index(spark, index)
        matches, candidates = infer(read(1), found, postings, classifier, threshold, **options)
        tables.write_tsv(matches, f"{output}/matching_results")
        tables.write_tsv(candidates, f"{output}/candidate_pairs")
        tables.require_same_provenance(before, mark())
        tables.write_report(before, f"{output}/provenance.json")
    if stage in ("validate", "run"):
        report_path = f"{output}/strict_qa.json"
        tables.remove_report(report_path)  # an earlier pass no longer holds
        tables.require_same_provenance(tables.read_report(f"{output}/provenance.json") or {}, mark())
        matches = tables.read_tsv(spark, f"{output}/matching_results", tables.MATCHING)
        candidates = tables.read_tsv(spark, f"{output}/candidate_pairs", tables.CANDIDATES)
        s1 = read(1)
        report["qa"] = validate(matches, candidates, s1, load_index(spark, index)[0], s1.count())
        tables.write_report(report["qa"], report_path)
    return report


def train_on_candidates(s1: DataFrame, found: DataFrame, index: DataFrame, truth: DataFrame, iterations: int = 60) -> tuple[PipelineModel, DataFrame]:
    """(model, scored validation pairs) from labelled candidates, split by entity."""
    records = normalized(s1)
    got = rare.production_candidates(records, found, index).select("s1_id", "candidate_id")
    both = rare.with_texts(got, records, found)
    both = both.withColumnsRenamed({f"{p}_{c}": f"{p}_business_{c}" for p in ("s1", "candidate") for c in ("name", "address")})
    labelled = pairs.label(features_16(both, normalized=True), truth)
    split = model.entity_split(s1).select(F.col("entity_id").alias("s1_id"), "split")
    marked = labelled.join(split, "s1_id")
    fitted = model.train(marked.where("split = 'train'"), list(FEATURES_16), model.build_classifier(iterations))
    return fitted, model.score(fitted, marked.where("split = 'validation'"))


def report(truth: DataFrame, matches: DataFrame) -> dict:
    counts = evaluate.entity_counts(truth, matches)
    return evaluate.macro_f05(counts).first().asDict() | evaluate.micro(counts).first().asDict()


def candidate_table(spark: SparkSession, data: str, index: str, method: str) -> DataFrame:
    """Candidates of source1.tsv: ``rare`` (production), ``scanning`` or ``tfidf``."""
    s1, found = normalized(tables.read_records(spark, f"{data}/source1.tsv", "S1-")), load_index(spark, index)
    if method == "tfidf":
        return tfidf.candidates(s1, found[0])
    return rare.scanning_candidates(s1, found[0]) if method == "scanning" else rare.production_candidates(s1, *found)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Resolve business records of one source against two others.")
    p.add_argument("stage", choices=["index", "infer", "validate", "run", "official", "candidates", "split", "package"])
    p.add_argument("--data", required=True)
    p.add_argument("--index", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--model")
    p.add_argument("--method", choices=["rare", "scanning", "tfidf"], default="rare")
    p.add_argument("--threshold", type=float, default=0.56)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("kindred").getOrCreate()
    if a.stage == "official":
        rules = official(spark, a.data, a.output, a.index)
        rules.show(truncate=False)
        if rules.where("severity = 'error'").limit(1).count():
            raise SystemExit(1)
    elif a.stage == "candidates":
        candidate_table(spark, a.data, a.index, a.method).write.parquet(a.output)
    elif a.stage == "split":
        model.entity_split(tables.read_records(spark, f"{a.data}/source1.tsv", "S1-")).write.partitionBy("split").parquet(a.output)
    elif a.stage == "package":
        names = ("matching_results.tsv", "candidate_pairs.tsv")
        print(json.dumps(tables.write_package(f"{a.output}.zip", {n: f"{a.data}/{n}" for n in names}, names), indent=2))
    else:
        if a.stage in ("infer", "run") and not a.model:
            p.error("--model is needed")
        fitted = model.load(a.model) if a.stage in ("infer", "run") else None
        print(json.dumps(run(spark, a.data, a.index, a.output, fitted, a.threshold, a.stage, a.model), indent=2, default=str))


if __name__ == "__main__":
    main()
