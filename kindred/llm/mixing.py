"""Mixing sources to target weights by a low-discrepancy schedule, DataFrame functions only.

Slot ``j`` of the mix owns the golden-ratio point ``frac(j * phi)``, which the sources' cumulative shares of the
slots map to a source; the slot's rank among its source's slots names the block of that source that it takes.
A source's documents, shuffled by a digest of their id, form one stream of words cut into equal blocks,
run through ``max_repeats`` times at most; slots join blocks on (source, block). Sources with small targets have
shorter blocks and so more slots a word, else they would get a whole block or none.

Scale: the texts are read once, for their sizes. Every running sum is in two levels (inside buckets, then
over the few bucket totals), so that a source with a third of all documents is no single task's work, and
slots are ranked inside ranges of slot numbers. Points meet sources through a grid of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import BLANKS, written

PHI = 0.6180339887498949
GRID = 1024


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ in the text (null: 0)."""
    plain = F.btrim(text, F.lit(BLANKS))
    pieces = F.size(F.split(plain, r"[\x20\x09-\x0D]+", -1)).cast("long")
    return F.when(text.isNull() | (plain == ""), F.lit(0).cast("long")).otherwise(pieces)


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2,
    block_words: int = 4096, least_slots: int = 65_536, source_slots: int = 128,
) -> DataFrame:
    """``source, source_size, weight, target, block, low, high, n_slots`` per source; [low, high) is its part of the slots.

    Sources in code point order, null last, take ``weights`` in turn. ``share`` times all words are dealt
    by weight; a target stops at ``max_repeats`` times its source's size and the excess goes to the
    others by weight until none is above: with sources ordered by size over weight, those that stop are a prefix.
    ``block``: ``block_words``, less where the whole mix would have under ``least_slots`` slots or the source itself
    under ``source_slots`` otherwise; a word at least. A null source is one of its own; a source of no words has target 0 and
    takes part in the order of weights. No rows give no rows; repeated rows count each; other columns are not read.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    by = by.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    by = by.withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    by = by.withColumns({
        "total": F.sum("source_size").over(everything) * share,
        "capped": F.sum("cap").over(fill) - F.col("cap"),  # all before this one
        "open": F.sum("weight").over(everything) - F.sum("weight").over(fill) + F.col("weight"),  # it and all after
    })
    by = by.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    # The first source that its level does not lift over its cap sets the level of it and of all after.
    stops = F.col("level") * F.col("weight") > F.col("cap")
    by = by.withColumn("final", F.min(F.when(~stops, F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    by = by.withColumn("target", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))))
    run = Window.orderBy(F.col("source").asc_nulls_last())
    longest = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.sum("target").over(everything) / least_slots)))
    by = by.withColumn("longest", longest)
    by = by.withColumn("block", F.greatest(F.lit(1), F.least("longest", F.floor(F.col("target") / source_slots))))
    # Where all blocks are equal, the parts of the slots are those of the targets to the last bit.
    by = by.withColumn("part", F.col("target") * (F.col("longest") / F.col("block")))
    by = by.withColumn("upto", F.sum("part").over(run))
    all_parts = F.sum("part").over(everything)
    return by.select(
        "source", "source_size", "weight", "target", "block",
        ((F.col("upto") - F.col("part")) / all_parts).alias("low"), (F.col("upto") / all_parts).alias("high"),
        F.floor(all_parts / F.col("longest")).alias("n_slots"),
    )


def slots(mix: DataFrame, n_slots: int, per_range: int = 100_000) -> DataFrame:
    """(slot, source, rank): the source of every slot and the slot's rank among its source's.

    Sources whose part is empty get no slot; without sources, or with ``n_slots`` 0, there are no rows.
    """
    spark = mix.sparkSession
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") * PHI - F.floor(F.col("id") * PHI)).alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * GRID))
    last = F.max("high").over(Window.partitionBy(F.lit(1)))
    spans = mix.where("high > low").withColumn("last", last)
    spans = spans.withColumn("high", F.when(F.col("high") == F.col("last"), F.lit(2.0)).otherwise(F.col("high")))
    spans = spans.select("source", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") * GRID), F.least(F.floor(F.col("high") * GRID), F.lit(GRID - 1)))).alias("cell"))
    named = points.join(spans, "cell").where("u >= low and u < high").select(
        "slot", "source", F.floor(F.col("slot") / per_range).alias("range"))
    counts = named.groupBy("source", "range").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("source").orderBy("range")
    base = counts.select("source", "range", (F.sum("n").over(upto) - F.col("n")).alias("base"))
    here = Window.partitionBy("range", "source").orderBy("slot")
    ranked = named.withColumn("here", F.row_number().over(here) - 1)
    return ranked.join(base.withColumnRenamed("source", "s"), (F.col("source").eqNullSafe(F.col("s"))) & (ranked["range"] == base["range"])).select(
        "slot", "source", (F.col("here") + F.col("base")).alias("rank"))


def _streams(sizes: DataFrame, seed: str, per_bucket: int = 50_000) -> DataFrame:
    """``start`` of every document in its source's shuffled stream of words."""
    n = sizes.count()
    # Buckets are prefixes of the digest, so that bucket order is digest order.
    digits = 1
    while 16**digits * per_bucket < n:
        digits += 1
    keyed = sizes.withColumn("turn", F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    keyed = keyed.withColumn("bucket", F.substring("turn", 1, digits))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("source").orderBy("bucket")
    base = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.sum("n").over(upto) - F.col("n")).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("turn", "doc_id", "size", "row")
    rows = keyed.withColumn("here", F.sum("size").over(inside) - F.col("size"))
    rows = rows.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return rows.withColumn("start", F.col("here") + F.col("base")).select("row", "doc_id", "source", "size", "start")


def plan(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeats: int = 2,
    block_words: int = 4096, least_slots: int = 65_536, source_slots: int = 128, seed: str = "mix",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, pieces) of the mix of ``docs``.

    pieces: ``slot, row, doc_id, source, epoch, begin, words``: slot by slot, the words [begin, begin + words) that
    the mix takes of a document. Blocks have ``block_words`` words, fewer where a small corpus would have under
    ``least_slots`` slots or a small source under ``source_slots`` otherwise. A slot that ends past a source's last repeat is cut there.
    Null, empty and blank texts have no pieces; null ids and sources, ties and repeated rows as in ``mixed_sizes``; an empty table gives
    three empty frames. Other columns are not read.
    """
    sizes = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))
    sizes = written(sizes.withColumn("row", F.monotonically_increasing_id()), "sizes")
    mix = written(targets(sizes, weights, share, max_repeats, block_words, least_slots, source_slots), "targets")
    taken = written(slots(mix, mix.agg(F.max("n_slots")).first()[0] or 0), "slots")
    streams = _streams(sizes, seed)
    span = mix.select(F.col("source").alias("s"), "source_size", F.col("block").alias("length"))
    parts = streams.where("size > 0").join(span, F.col("source").eqNullSafe(F.col("s"))).select(
        "row", "doc_id", "source", "size", "start", "source_size", "length", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("epoch"))
    parts = parts.withColumn("start", F.col("start") + F.col("epoch") * F.col("source_size"))
    parts = parts.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / F.col("length")), F.floor((F.col("start") + F.col("size") - 1) / F.col("length")))))
    begin = F.greatest(F.col("start"), F.col("block") * F.col("length"))
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("length"))
    parts = parts.select(
        "row", "doc_id", "source", "epoch", "block", (begin - F.col("start")).alias("begin"), (end - begin).alias("words"))
    ranks = taken.select("slot", F.col("source").alias("s"), F.col("rank"))
    pieces = parts.join(ranks, (F.col("block") == F.col("rank")) & F.col("source").eqNullSafe(F.col("s"))).drop("s", "rank", "block")
    return sizes, mix, pieces


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``.

    Null, empty and blank texts have size 0 and are taken 0 times; a null source is a source of its own,
    last in order; rows that repeat an id are dealt in one after the other; a null id is an id. Other
    columns are not read. An empty table gives no rows. Reruns agree, whatever the partitions, but for
    which of several rows equal in id, source and size comes first.
    """
    sizes, mix, pieces = plan(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    span = mix.select(F.col("source").alias("s"), "source_size", "target")
    out = sizes.join(taken, "row", "left").join(span, F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
