"""Retrieval through rare character n-grams.

Document frequencies are partial aggregates over distinct grams; grams above the cap go *before* any
join, which bounds every posting list, so the probe's fan-out is at most cap times anchors per record. Normalized
records, target grams and anchors are each written once and read by every step that needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.functions.features import rerank_scores
from kindred.operators import blocking, packed
from kindred.sources.stage import written

#: kind -> (column, gram sizes, anchors kept): production, and the variant that scans targets.
PRODUCTION = {"n": ("name", (4, 6), 6), "a": ("address", (5, 8), 8)}
SCANNING = {"n": ("name", (4,), 6), "a": ("address", (5,), 8)}


def grams(records: DataFrame, setup=PRODUCTION, bucket_bits: int | None = None) -> DataFrame:
    """(entity_id, country, kind, gram), distinct per record; with ``bucket_bits`` grams are CRC-32 buckets."""
    def of(kind: str, column: str, sizes: tuple):
        return F.transform(text.char_ngrams(column, *sizes), lambda g: F.struct(F.lit(kind).alias("kind"), g.alias("gram")))

    arrays = F.concat(*(of(kind, column, sizes) for kind, (column, sizes, _) in setup.items()))
    out = records.select("entity_id", "country", F.explode(arrays).alias("g")).select("entity_id", "country", "g.kind", "g.gram")
    if bucket_bits:
        bucket = text.gram_bucket(F.coalesce("country", F.lit("")), F.col("kind"), F.col("gram"), bucket_bits)
        out = out.withColumn("gram", bucket.cast("string")).distinct()
    return out


def document_frequency(of: DataFrame) -> DataFrame:
    return of.groupBy("country", "kind", "gram").agg(F.count("*").alias("df"))


def postings(target_grams: DataFrame, cap: int = 24) -> DataFrame:
    """(country, kind, gram, entity_id, df) of grams in at most ``cap`` targets."""
    rare = document_frequency(target_grams).where(F.col("df") <= cap)
    return target_grams.join(rare, ["country", "kind", "gram"])


def anchors(s1_grams: DataFrame, frequency: DataFrame, setup=PRODUCTION, cap: int = 24) -> DataFrame:
    """The rarest grams of every S1 record and kind, and how many it kept: ``s1_id, country, kind, gram, df, n_kept``."""
    rare = frequency.where((F.col("df") > 0) & (F.col("df") <= cap))
    per = Window.partitionBy("entity_id", "kind")
    most = F.when(F.col("kind") == "n", setup["n"][2]).otherwise(setup["a"][2])
    out = s1_grams.join(rare, ["country", "kind", "gram"])
    out = out.withColumn("turn", F.row_number().over(per.orderBy("df", "gram"))).where(F.col("turn") <= most)
    out = out.withColumn("n_kept", F.count("*").over(per))
    return out.select(F.col("entity_id").alias("s1_id"), "country", "kind", "gram", "df", "n_kept")


def hits(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """Per pair: anchor hits of both kinds, and the score: the share of each kind's anchors that hit, summed."""
    met = chosen.join(index.select("country", "kind", "gram", F.col("entity_id").alias("candidate_id")), ["country", "kind", "gram"])
    count = lambda kind: F.count_if(F.col("kind") == kind)
    kept = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("n_kept")))
    part = lambda kind: F.coalesce(count(kind) / kept(kind), F.lit(0.0))
    return met.groupBy("s1_id", "candidate_id").agg(
        count("n").alias("name_anchor_hits"), count("a").alias("address_anchor_hits"),
        part("n").alias("name_coverage"), part("a").alias("address_coverage"),
        (part("n") + part("a")).alias("anchor_score"))


def anchor_hits(s1: DataFrame, others: DataFrame, setup=PRODUCTION, cap: int = 24) -> DataFrame:
    """``hits`` of records with basic normalization, their grams as numbers: frequencies are summed up by tasks, and only
    grams that may be rare (S1) or anchors (targets) leave a task."""
    s1, others = written(s1, "s1"), written(others, "targets")
    rare = written(packed.document_frequency(others, setup).where(F.col("df") <= cap), "frequency")
    chosen = written(anchors(packed.sifted(s1, setup, rare), rare, setup, cap), "anchors")
    return hits(chosen, packed.sifted(others, setup, chosen))


def preselect(pairs: DataFrame, k: int = 80) -> DataFrame:
    """Best ``k`` per S1 and source by anchor score, ties to the larger id."""
    turn = Window.partitionBy("s1_id", "source").orderBy(F.desc("anchor_score"), F.desc("candidate_id"))
    return pairs.withColumn("source", text.id_source("candidate_id")).withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= k).drop("turn")


def with_texts(pairs: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs with both records' names and addresses as s1_* and candidate_*."""
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), F.col("name").alias(f"{p}_name"), F.col("address").alias(f"{p}_address"), F.col("country").alias(f"{p}_country"))
    return pairs.join(side(s1, "s1", "s1_id"), "s1_id").join(side(others, "candidate", "candidate_id"), "candidate_id")


def by_entity(pairs: DataFrame) -> DataFrame:
    """Pairs dealt out by S1 record, as the ranking needs them, to all shuffle partitions: scoring is CPU, however few bytes they are."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1_id")


def rerank(pairs: DataFrame, k: int = 50) -> DataFrame:
    """Best ``k`` per S1 and source: both fields equal, then 0.6 name + 0.4 address, name, address, larger id."""
    out = rerank_scores(pairs)
    both = (F.col("s1_name") != "") & (F.col("s1_address") != "") & (F.col("s1_name") == F.col("candidate_name")) & (F.col("s1_address") == F.col("candidate_address"))
    out = out.withColumns({"both_exact": both, "score": 0.6 * F.col("name_score") + 0.4 * F.col("address_score"), "source": text.id_source("candidate_id")})
    order = [F.desc("both_exact"), F.desc("score"), F.desc("name_score"), F.desc("address_score"), F.desc("candidate_id")]
    return out.withColumn("rank", F.row_number().over(Window.partitionBy("s1_id", "source").orderBy(*order))).where(F.col("rank") <= k)


def production_candidates(
    s1: DataFrame, others: DataFrame, index: DataFrame | None = None, cap: int = 24, pre_k: int = 80, top_k: int = 50,
    exact_limit: int = 512, bucket_bits: int | None = None,
) -> DataFrame:
    """Candidates of every S1 record: rare-gram hits and capped exact lookups, reranked, ``top_k`` per source."""
    s1, others = written(s1, "s1"), written(others, "targets")
    if index is None:
        index = written(grams(others, bucket_bits=bucket_bits), "grams")
        frequency = document_frequency(index)
    else:
        frequency = index.select("country", "kind", "gram", "df").distinct()
    # Anchors are rare grams only, so that probing with them bounds the postings that are read.
    chosen = written(anchors(written(grams(s1, bucket_bits=bucket_bits), "s1-grams"), frequency, cap=cap), "anchors")
    found = preselect(hits(chosen, index), pre_k).select("s1_id", "candidate_id")
    exact = blocking.exact_capped(s1, others, exact_limit).select("s1_id", "candidate_id")
    pairs = written(found.unionByName(exact).distinct(), "pairs")
    return rerank(with_texts(by_entity(pairs), s1, others), top_k).select("s1_id", "candidate_id", "source", "both_exact", "name_score", "address_score", "score", "rank")


def cheap_filter(pairs: DataFrame) -> DataFrame:
    """Pairs with two hits of one kind, or half of one kind's anchors."""
    return pairs.where((F.col("name_anchor_hits") >= 2) | (F.col("address_anchor_hits") >= 2) | (F.greatest("name_coverage", "address_coverage") >= 0.5))


def scanning_candidates(s1: DataFrame, others: DataFrame, cap: int = 6, pre_k: int = 80, top_k: int = 50) -> DataFrame:
    """The variant whose index is on S1: anchors rare among S1 records, targets probe, exact matches uncapped.

    score = 0.85 best similarity + 0.15 best coverage; ties to the larger candidate id.
    """
    s1, others = written(s1, "s1"), written(others, "targets")
    own = written(grams(s1, SCANNING), "s1-grams")
    chosen = written(anchors(own, document_frequency(own), SCANNING, cap), "anchors")
    met = cheap_filter(hits(chosen, grams(others, SCANNING)))
    pre = preselect(met, pre_k).withColumn("retrieval_method", F.lit("rare_anchor"))
    scored = rerank_scores(with_texts(by_entity(pre), s1, others))
    best = F.greatest("name_score", "address_score")
    scored = scored.withColumn("score", 0.85 * best + 0.15 * F.greatest("name_coverage", "address_coverage"))
    turn = Window.partitionBy("s1_id", "source").orderBy(F.desc("score"), F.desc("candidate_id"))
    scored = scored.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= top_k)
    columns = ["s1_id", "candidate_id", "score", "retrieval_method"]
    exact = blocking.exact_methods(s1, others).withColumn("score", F.lit(1.0)).select(*columns)
    return blocking.first_per_pair(scored.select(*columns).unionByName(exact))
