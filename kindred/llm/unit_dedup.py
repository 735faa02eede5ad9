"""Substring dedup by hashing units of the text and keeping the earliest occurrence of each.

Units are lines of at least ``min_words`` words and, since passages also begin and end inside lines, the short word
runs between content-defined anchors: a word is an anchor if the fingerprint of the three words from it on is the least of
some window of ``window`` neighbouring words. Anchors depend on nearby words alone, so a passage is cut alike wherever
it stands. Words are lower-cased and the white space between them does not count. A passage of at least
``2 * window + 1 + min_words`` words shows at least ``min_words`` words of whole runs in each document.

Scale: the texts are read once and never shuffled; a unit travels as 128-bit digest, document and
number. Counts per digest are partial aggregates, so that a unit common to a third of all documents is
one row per task; only repeated units are joined back, with a table whose large keys the join can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, written
from kindred.llm.texthash import U, mix, seeds, words

_ANCHOR = seeds(3, 11) | U(1)
_LANES = [(U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64)), U(21)),
          (U(0xC2B2AE3D27D4EB4F), U(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64)), U(42))]


def anchors(w: np.ndarray, window: int) -> np.ndarray:
    """Sorted first words of the units of one text (robust winnowing: gaps of ``window`` at most)."""
    if not w.size:
        return np.empty(0, np.int64)
    padded = np.concatenate([w, np.zeros(2, U)])
    rank = mix(padded[:-2] * _ANCHOR[0] + padded[1:-1] * _ANCHOR[1] + padded[2:] * _ANCHOR[2])
    if w.size <= window:
        return np.array([0])
    least = sliding_window_view(rank, window).argmin(axis=1)
    return np.unique(np.append(least + np.arange(least.size), 0))


def digests(w: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of the word sequence of each unit."""
    lens = np.diff(np.append(starts, w.size))
    place = np.arange(w.size) - np.repeat(starts, lens)
    out = []
    for base, _, salt in _LANES:
        powers = np.cumprod(np.full(int(lens.max()) + 1, base, dtype=U), dtype=U)
        part = mix(w ^ salt) * powers[place]
        out.append(mix(np.add.reduceat(part, starts) + lens.astype(U)).view(np.int64))
    return out[0], out[1]


_UNITS = "doc_id long, line boolean, unit int, h1 long, h2 long, n_words int, start int, stop int, again boolean"
_KINDS = (np.int64, bool, np.int32, np.int64, np.int64, np.int32, np.int32, np.int32, bool)
_LINE = np.int64(0x5851F42D4C957F2D)  # keeps the digests of lines apart from those of runs


def _cut(units: tuple[str, ...], window: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in _KINDS]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w, begin, end, raw = words(text)
                if not w.size:
                    continue
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
                for unit in units:
                    line = unit == "lines"
                    if line:
                        starts = np.flatnonzero(np.diff(np.searchsorted(np.flatnonzero(raw == 10), begin), prepend=-1))
                    else:
                        starts = anchors(w, window)
                    lens = np.diff(np.append(starts, w.size))
                    h1, h2 = digests(w, starts)
                    number = np.arange(starts.size)
                    if line:
                        long = np.flatnonzero(lens >= min_words)
                        starts, lens, h1, h2, number = starts[long], lens[long], h1[long] ^ _LINE, h2[long], number[long]
                    again = np.ones(starts.size, bool)
                    again[np.unique(h1 ^ (h2 << 1), return_index=True)[1]] = False  # 64 bits are enough inside one text
                    row = (np.full(starts.size, doc), np.full(starts.size, line), number, h1, h2, lens, chars[begin[starts]], chars[end[starts + lens - 1]], again)
                    for col, x in zip(cols, row, strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*c, np.empty(0, k)]).astype(k)) for c, k in zip(cols, _KINDS, strict=True)],
                names=["doc_id", "line", "unit", "h1", "h2", "n_words", "start", "stop", "again"],
            )

    return run


def repeated_spans(
    docs: DataFrame, units: tuple[str, ...] = ("lines", "runs"), window: int = 16, min_words: int = 18, within_document: bool = True
) -> DataFrame:
    """Spans of ``docs.text`` that repeat an earlier-ranked occurrence (smaller doc_id, then unit).

    Returns ``doc_id, line, start, stop, n_words, kept_doc_id, kept_doc_ids``: code-point offsets [start, stop) in
    the original text of a run of consecutive repeated units (whole lines, or runs of words) of ``min_words`` words or more,
    and the documents that keep their earliest occurrences (smallest, and all). A repeat is a passage of that many words:
    shorter ones are none. Spans of lines and of runs overlap. Repeats inside the document that holds the earliest occurrence
    count unless ``within_document`` is false.

    Null, empty and blank texts have no units; rows with a null id are left out; rows that share an id
    and text show the same spans once. An empty table gives no rows. Other columns are not read.
    """
    if set(units) - {"lines", "runs"}:
        raise ValueError(f"units: {units!r}")
    bounded_batches(docs.sparkSession)
    docs = docs.where("doc_id is not null and text is not null")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = written(docs.mapInArrow(_cut(units, window, min_words), _UNITS), "units")
    firsts = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("kept_doc_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeat = F.col("doc_id") > F.col("kept_doc_id")
    repeat = repeat | F.col("again") if within_document else repeat
    again = found.join(written(firsts, "repeated"), ["h1", "h2"]).where(repeat)
    again = again.select("doc_id", "line", "unit", "n_words", "start", "stop", "kept_doc_id").distinct()
    order = Window.partitionBy("doc_id", "line").orderBy("unit", "start")
    runs = again.withColumn("run", F.col("unit") - F.row_number().over(order))
    runs = runs.groupBy("doc_id", "line", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("n_words").alias("n_words"),
        F.min("kept_doc_id").alias("kept_doc_id"), F.array_sort(F.collect_set("kept_doc_id")).alias("kept_doc_ids"),
    )
    return runs.where(F.col("n_words") >= min_words).drop("run")


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans (``doc_id, start, stop``; they may overlap or repeat) cut out of ``text``.

    Every other column stays as it is, and so do texts without spans, null texts and rows with a null id. Rows that share an id all
    lose its spans; what of a span lies behind the end of a text is nothing. No documents give no rows.
    """
    cuts = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cuts"))
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(F.col(f"`{c}`") for c in names)) if names else F.lit(None)
    out = docs.select("doc_id", "text", rest.alias("rest")).join(cuts, "doc_id", "left")
    text = F.col("text")
    pieces = F.aggregate(
        "cuts",
        F.struct(F.lit("").alias("s"), F.lit(0).alias("at")),
        lambda acc, c: F.struct(
            F.concat(acc["s"], F.substring(text, acc["at"] + 1, c["start"] - acc["at"])).alias("s"), F.greatest(acc["at"], c["stop"]).alias("at")
        ),
        lambda acc: F.concat(acc["s"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    cut = F.when(F.col("cuts").isNull(), text).otherwise(pieces)
    return out.select(*(F.col(c) if c == "doc_id" else cut.alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns))
