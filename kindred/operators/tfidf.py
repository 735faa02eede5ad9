"""TF-IDF cosine blocking on character grams inside words.

Country, source and field are grouping keys, so all corpora run as one job. Weight: tf * (ln((1 + N) / (1 + df)) + 1), rows
of unit length, grams in at least two documents. The similarity join prunes by prefix: a pair whose
cosine reaches the bound shares a gram among either side's rarest grams outside which the remaining
weight is too short, so common grams only serve to finish the score of pairs that a rarer one proposed. It shuffles every proposed pair: top lists of
large corpora come from ``neighbours``, in blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.operators import blocking
from kindred.operators.neighbours import neighbours
from kindred.sources.stage import written


def corpora(s1: DataFrame, others: DataFrame, fields=("name", "address", "combined")) -> DataFrame:
    """(country, source, field, side, entity_id, text): S1 stands in the corpus of every target source of its country."""
    combined = F.btrim(F.concat_ws(" ", "name", "address"))
    s1, others = (d.where("country is not null").withColumn("combined", combined) for d in (s1, others))
    flat = lambda d: F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields)))
    right = others.withColumn("source", text.id_source("entity_id"))
    right = right.select("country", "source", F.lit("t").alias("side"), "entity_id", flat(right).alias("x"))
    pairs = right.select("country", "source").distinct()
    left = s1.join(pairs, "country").select("country", "source", F.lit("s1").alias("side"), "entity_id", flat(s1).alias("x"))
    return left.unionByName(right).select("country", "source", F.col("x.field").alias("field"), "side", "entity_id", F.col("x.text").alias("text"))


def weights(corpus: DataFrame, min_df: int = 2) -> DataFrame:
    """Unit-length gram weights of every document, as a written table."""
    key = ["country", "source", "field"]
    corpus = written(corpus, "corpus")
    sizes = corpus.groupBy(*key).agg(F.count("*").alias("n"))
    tf = corpus.select(*key, "side", "entity_id", F.explode(text.word_boundary_grams("text")).alias("gram"))
    tf = written(tf.groupBy(*key, "side", "entity_id", "gram").agg(F.count("*").alias("tf")), "tf")
    df = tf.groupBy(*key, "gram").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)
    idf = df.join(sizes, key).select(*key, "gram", "df", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    w = tf.join(idf, [*key, "gram"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = w.groupBy(*key, "side", "entity_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    out = w.join(norm, [*key, "side", "entity_id"])
    return written(out.select(*key, "side", "entity_id", "gram", "df", (F.col("w") / F.col("norm")).alias("w")), "weights")


def cosine_pairs(weighted: DataFrame, bound: float = 0.25, top_n: int | None = 30) -> DataFrame:
    """(country, source, field, s1_id, candidate_id, score): the best ``top_n`` (null: all) per S1 record with score >= ``bound``."""
    key = ["country", "source", "field"]
    # With both rows of unit length, what an S1 record's grams after position p add is at most the length of their weights.
    rarest = Window.partitionBy(*key, "side", "entity_id").orderBy("df", "gram")
    rest = rarest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marked = weighted.withColumn("left_over", F.sqrt(F.sum(F.col("w") * F.col("w")).over(rest)))
    prefix = marked.where((F.col("side") == "s1") & (F.col("left_over") >= bound - 1e-9))
    left = weighted.where("side = 's1'").select(*key, "gram", F.col("entity_id").alias("s1_id"), F.col("w").alias("w1"))
    right = weighted.where("side = 't'").select(*key, "gram", F.col("entity_id").alias("candidate_id"), F.col("w").alias("w2"))
    proposed = prefix.select(*key, "gram", F.col("entity_id").alias("s1_id")).join(right, [*key, "gram"])
    proposed = proposed.select(*key, "s1_id", "candidate_id").distinct()
    score = proposed.join(left, [*key, "s1_id"]).join(right, [*key, "candidate_id", "gram"])
    score = score.groupBy(*key, "s1_id", "candidate_id").agg(F.sum(F.col("w1") * F.col("w2")).alias("score"))
    turn = Window.partitionBy(*key, "s1_id").orderBy(F.desc(F.round("score", 12)), "candidate_id")
    score = score.where(F.col("score") >= bound)
    if top_n is None:
        return score
    return score.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= top_n).drop("turn")


def candidates(s1: DataFrame, others: DataFrame, top_n: int = 20, address_bound: float = 0.25) -> DataFrame:
    """Exact names and TF-IDF neighbours on three fields: best score per pair, ranked per S1 record.

    ``address_bound`` applies to addresses alone; names and combined texts use 0.25.
    """
    bounds = {"name": 0.25, "address": address_bound, "combined": 0.25}
    found = neighbours(s1, others, tuple(bounds), bounds, top_n)
    everything = found.select("s1_id", "candidate_id", "score").unionByName(blocking.exact_name(s1, others))
    # By S1 record at once, so that the pairs do not move again to be ranked.
    return ranked(everything.repartition("s1_id").groupBy("s1_id", "candidate_id").agg(F.max("score").alias("score")))


def ranked(pairs: DataFrame) -> DataFrame:
    """The five-column candidate table."""
    turn = Window.partitionBy("s1_id").orderBy(F.desc(F.round("score", 12)), "candidate_id")
    return pairs.select(
        F.col("s1_id").alias("source1_entity_id"), F.col("candidate_id").alias("candidate_entity_id"),
        text.id_source("candidate_id").alias("candidate_source"), F.col("score").alias("retrieval_score"),
        F.row_number().over(turn).alias("retrieval_rank"))
