"""Character n-grams as numbers, for corpora whose grams are too many to be shuffled as rows.

A gram of up to eight letters a-z and digits is a number of eight digits to the base 37, filled up with zeros on the right, so
that numbers differ and sort as the texts do. Every task counts its own grams before anything moves; grams of records leave a
task only where a bitmap of the wanted ones lets them through, which loses none of these and which a join confirms.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places of the bitmap (16 MB), and the factors of the two places of each gram.
PLACES = 134_217_689  # a prime
FACTORS = (1, 40_503)
#: Counts that a task holds before it merges them, and rows of one batch that leaves Python.
HELD, BATCH = 8_000_000, 200_000
#: Rows of records looked at together: their numbers share 64 bits with the gram's 42, and characters bound the memory.
ROWS, CHARACTERS = 1 << 21, 2_000_000

_DIGITS = np.zeros(256, np.int64)
for _i, _c in enumerate(b"0123456789abcdefghijklmnopqrstuvwxyz"):
    _DIGITS[_c] = _i + 1


def code(gram: str) -> int:
    """The number of one gram."""
    return sum(int(_DIGITS[ord(c)]) * 37 ** (7 - i) for i, c in enumerate(gram))


def _distinct(texts: pa.Array, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(number, place of the text) of the distinct grams of every text without its spaces, by number."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), " ", "")
    lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
    raw = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    digits = _DIGITS[raw]
    if len(raw) != lengths.sum() or not digits.all():
        raise ValueError("grams as numbers need texts with basic normalization")
    row, out = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths), []
    for n in sizes:
        if len(raw) >= n:
            whole = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :])
            value = np.zeros(len(raw) - n + 1, np.int64)
            for i in range(n):
                value += digits[i : len(raw) - n + 1 + i] * 37 ** (7 - i)
            out.append(value[whole] << 21 | row[whole])
    both = np.sort(np.concatenate(out)) if out else np.empty(0, np.int64)
    both = both[np.diff(both, prepend=-1) != 0]
    return both >> 21, both & (ROWS - 1)


def _parts(batches: Iterator[pa.RecordBatch], setup) -> Iterator[tuple]:
    """(country, kind, ids, numbers, places among the ids) of slices of the batches; records without a country go."""
    for batch in batches:
        for country in pc.unique(batch["country"]).drop_null().to_pylist():
            own = batch.filter(pc.equal(batch["country"], country))
            for kind, (column, sizes, _) in setup.items():
                ends = np.cumsum(pc.fill_null(pc.binary_length(own[column]), 0).to_numpy().astype(np.int64))
                at = 0
                while at < len(own):
                    upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARACTERS)))
                    yield country, kind, own["entity_id"].slice(at, upto - at), *_distinct(own[column].slice(at, upto - at), sizes)
                    at = upto


def document_frequency(records: DataFrame, setup) -> DataFrame:
    """(country, kind, gram, df): in how many records of a country each gram stands, ``gram`` as a number."""
    def merged(held: list) -> list:
        gram, n = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
        order = np.argsort(gram, kind="stable")
        first = np.flatnonzero(np.diff(gram[order], prepend=-1))
        return [(gram[order][first], np.add.reduceat(n[order], first))] if len(gram) else []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        new = 0
        for country, kind, _, gram, _ in _parts(batches, setup):
            first = np.flatnonzero(np.diff(gram, prepend=-1))
            held.setdefault((country, kind), []).append((gram[first], np.diff(first, append=len(gram))))
            new += len(first)
            if new > HELD:
                held, new = {k: merged(v) for k, v in held.items()}, 0
                if sum(len(x[0]) for v in held.values() for x in v) > HELD:  # large tasks hand on what they have
                    yield from told(held)
                    held = {}
        yield from told({k: merged(v) for k, v in held.items()})

    def told(held: dict) -> Iterator[pa.RecordBatch]:
        for (country, kind), parts in held.items():
            for gram, n in parts:
                for i in range(0, len(gram), BATCH):
                    k = len(gram[i : i + BATCH])
                    yield pa.RecordBatch.from_arrays([pa.array([country] * k, pa.string()), pa.array([kind] * k, pa.string()), pa.array(gram[i : i + BATCH]), pa.array(n[i : i + BATCH].astype(np.int64))], ["country", "kind", "gram", "n"])

    rows = records.select("entity_id", "country", *(c for c, _, _ in setup.values()))
    return rows.mapInArrow(count, "country string, kind string, gram long, n long").groupBy("country", "kind", "gram").agg(F.sum("n").alias("df"))


def bitmap(wanted: DataFrame) -> bytes:
    """A bit at both places of every (country, kind, gram) of ``wanted``."""
    salt = F.crc32(F.concat("country", "kind").cast("binary"))
    places = F.explode(F.array(*(F.pmod(F.col("gram") * F.lit(f) + salt, F.lit(PLACES)) for f in FACTORS)))
    places = wanted.select(places.alias("at")).select(F.shiftright("at", 15).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 15) - 1)).alias("place"))
    out = np.zeros((PLACES >> 15) + 1 << 12, np.uint8)
    for r in places.groupBy("part").agg(F.bitmap_construct_agg("place").alias("bits")).toLocalIterator():
        out[r["part"] << 12 : r["part"] + 1 << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.tobytes()


def sifted(records: DataFrame, setup, wanted: DataFrame) -> DataFrame:
    """(entity_id, country, kind, gram), distinct per record, of all grams among ``wanted`` and a few others."""
    shipped = records.sparkSession.sparkContext.broadcast(bitmap(wanted))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shipped.value, np.uint8)
        for country, kind, ids, gram, row in _parts(batches, setup):
            salt = crc32((country + kind).encode())
            for f in FACTORS:
                at = (gram * f + salt) % PLACES
                hit = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                gram, row = gram[hit], row[hit]
            for i in range(0, len(gram), BATCH):
                k = len(gram[i : i + BATCH])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[i : i + BATCH])).cast(pa.string()), pa.array([country] * k, pa.string()), pa.array([kind] * k, pa.string()), pa.array(gram[i : i + BATCH])], ["entity_id", "country", "kind", "gram"])

    rows = records.select("entity_id", "country", *(c for c, _, _ in setup.values()))
    return rows.mapInArrow(sift, "entity_id string, country string, kind string, gram long")
