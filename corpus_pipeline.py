"""A training corpus from ``documents``: five stages, each written and read again before the next.

Language ID drops documents without a language, line dedup cuts lines that many documents share, MinHash
near-dedup keeps one document of each group, the mix repeats or leaves out documents so that sources come
near their targets, and byte-level BPE turns the texts into tokens.

Every stage takes null ids, texts, labels and sources, empty and very long texts, repeated rows and empty tables: see the
operators' own statements. Rows that share an id stay or go together; further columns of ``documents`` are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import bpe, language_id, line_dedup, mixing, odd_minhash
from kindred.llm.common import bounded_batches, finished
from kindred.llm.queries import tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bounds of an Arrow batch, unless the session states some: executors run all stages, and keep the largest buffers of each.
BATCH_ROWS, BATCH_BYTES = 250, 2 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is named; ``lang`` stays as it came. Null texts and those without a letter (``und``) go, and
    all texts where no row has a label and text to learn from."""
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    out = language_id.predict(docs, model)
    return out.where(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines found in ten or more; ``n_chars`` follows the text (null text: 0)."""
    out = line_dedup.line_dedup(docs)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.lit(0).cast("long"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id; documents without an id or without words stay."""
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    gone = odd_minhash.near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole number of times; those of no words go."""
    sizes = mixing.mixed_sizes(docs).select("doc_id", F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int").alias("times"))
    times = sizes.groupBy("doc_id").agg(F.max("times").alias("times")).where("times > 0")
    out = docs.join(times.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id"))).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text (null: no ids)."""
    bounded_batches(spark, BATCH_ROWS, BATCH_BYTES)
    path, pattern = tokenizer()
    out = bpe.round_trip(docs.select("doc_id", "text", "source"), path, pattern)
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("source_mix", mix),
    ("byte_bpe", tokens),
]

#: SQL can express neither the classifier nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = finished(spark, name, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return docs
