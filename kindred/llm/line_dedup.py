"""Line dedup on range-partitioned hashes, DataFrame functions only.

Every line's key becomes a 128-bit digest. (digest, document, position) rows are written once, dealt out by *range*
over the digest and sorted by digest, document and position; the sorted stream shows each document's first occurrence of a
digest, and with it how many documents hold it, so rows are kept or dropped where they stand. What comes back
per document is a keep bitmap in run-length form, a few numbers however long the text is.

Scale: texts are read twice, once for digests and once to apply the bitmaps; the text itself moves once. A digest
with more than one in ``HOT`` of all lines (and over ``EASY``), of which there can be ``HOT`` at most, would make one range too large:
such digests are counted by partial aggregates and decided by a broadcast, and leave the stream before it is dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import BLANKS, lower_ascii, written

HOT = 4096
#: Rows of a digest that are never too many for one range.
EASY = 1000
#: Groups of digests counted to find those that can hold a hot one: few rows a task, four times as many as ``HOT``.
_GROUPS = 4 * HOT


def line_keys(text: Column) -> Column:
    """Keys of the lines of ``text``: ends stripped of [\\x20\\x09-\\x0D], A-Z lower-cased."""
    lines = F.split(lower_ascii(text), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """(digest, doc_id, pos) of the lines whose key has at least ``min_chars`` code points."""
    lines = docs.select("doc_id", F.posexplode(line_keys(F.col("text"))).alias("pos", "key"))
    lines = lines.where(F.char_length("key") >= min_chars)
    return lines.select(F.unhex(F.md5("key")).alias("digest"), "doc_id", "pos")


def hot_digests(lines: DataFrame) -> DataFrame:
    """``digest, n_docs, first`` of the digests with over one in ``HOT`` of the rows of the written ``lines``, and over ``EASY``: ``HOT`` digests at most."""
    least = max(EASY, lines.count() // HOT)
    group = F.pmod(F.xxhash64("digest"), F.lit(_GROUPS))
    # Only a group with as many rows can hold such a digest, and at most HOT groups have.
    full = lines.groupBy(group.alias("group")).count().where(F.col("count") > least).select("group")
    some = lines.withColumn("group", group).join(F.broadcast(full), "group", "left_semi")
    hot = some.groupBy("digest").count().where(F.col("count") > least).select("digest")
    per_doc = lines.join(F.broadcast(hot), "digest", "left_semi").groupBy("digest", "doc_id").agg(F.min("pos").alias("pos"))
    return per_doc.groupBy("digest").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "pos")).alias("first"))


def sorted_stream(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """``lines`` in ranges of digests, sorted, with ``n_docs`` that hold the digest and ``turn`` of the row among its digest's."""
    ranged = lines.repartitionByRange(*([partitions] if partitions else []), "digest").sortWithinPartitions("digest", "doc_id", "pos")
    stream = Window.partitionBy("digest").orderBy("doc_id", "pos")
    new = F.coalesce(F.lag("doc_id").over(stream) != F.col("doc_id"), F.lit(True))
    out = ranged.withColumns({"new": new.cast("long"), "turn": F.row_number().over(stream)})
    return out.withColumn("n_docs", F.sum("new").over(Window.partitionBy("digest"))).drop("new")


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, partitions: int | None = None
) -> DataFrame:
    """Documents that lose a line: ``doc_id, dropped`` with the dropped lines as sorted runs.

    dropped: array<struct<start, length>>, the zero runs of the document's keep bitmap. A key found
    in at least ``min_docs`` documents loses all its lines, or all but its earliest occurrence
    (smallest doc_id, then position) with ``keep_first``. Rows with a null text or id lose nothing.
    """
    lines = written(occurrences(docs.where("text is not null and doc_id is not null"), min_chars), "lines")
    hot = written(hot_digests(lines), "hot")
    rest = sorted_stream(lines.join(F.broadcast(hot), "digest", "left_anti"), partitions).where(F.col("n_docs") >= min_docs)
    often = lines.join(F.broadcast(hot.where(F.col("n_docs") >= min_docs)), "digest")
    if keep_first:
        rest = rest.where("turn > 1")
        often = often.where("doc_id <> first.doc_id or pos <> first.pos")
    gone = rest.select("doc_id", "pos").unionByName(often.select("doc_id", "pos"))
    # Rows that share an id may name a position twice.
    runs = gone.withColumn("run", F.col("pos") - F.dense_rank().over(Window.partitionBy("doc_id").orderBy("pos")))
    runs = runs.groupBy("doc_id", "run").agg(F.min("pos").alias("start"), (F.max("pos") - F.min("pos") + 1).cast("int").alias("length"))
    return runs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("dropped"))


def kept_text(text: Column, dropped: Column) -> Column:
    """``text`` without the lines in the runs of ``dropped`` (null: none)."""
    lines = F.split(text, "\n", -1)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(
        F.element_at(dropped, i)["start"] + F.element_at(dropped, i)["length"])
    end = lambda i: F.when(i == F.size(dropped), F.size(lines)).otherwise(F.element_at(dropped, i + 1)["start"])
    spans = F.transform(F.sequence(F.lit(0), F.size(dropped)), lambda i: F.slice(lines, begin(i) + 1, end(i) - begin(i)))
    return F.when(dropped.isNull(), text).otherwise(F.array_join(F.flatten(spans), "\n"))


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, partitions: int | None = None
) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, and ``n_lines``, ``n_dropped`` added.

    All other columns stay as they are; columns of these two names are replaced. Null text stays null
    and counts as one empty line. Keys with no code points are never dropped. A document id should
    be unique; rows that share one count as one document and lose the union of its lines. Rows with a
    null id stay whole. An empty table gives no rows. A text whose lines all go becomes empty.
    """
    docs = docs.drop("n_lines", "n_dropped")
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), min_docs, min_chars, keep_first, partitions)
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The rest rides along in a struct, so no column of the caller can clash with ours.
    whole = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in names)).alias("rest") if names else F.lit(None).alias("rest"))
    out = whole.join(bitmaps, "doc_id", "left")
    gone = F.aggregate("dropped", F.lit(0), lambda n, r: n + r["length"])
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)).cast("long"), F.lit(1).cast("long"))
    n_lines = F.when(F.col("text").isNull(), F.lit(1).cast("long")).otherwise(n_lines)
    return out.select(
        *(F.col("doc_id") if c == "doc_id" else kept_text(F.col("text"), F.col("dropped")).alias("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns),
        n_lines.alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"),
    )
