"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier one: a minimal perfect hash of the vocabulary resolves every pre-token that is a token itself.
Tier two: other pre-tokens are merged with a heap of ranked pairs over a linked list of bytes. Both tiers
stand behind bounded memos of pre-tokens and of blank-separated chunks; a batch is cut into chunks and put
together again by Arrow, which looks up each distinct chunk once. Tables travel as one
broadcast whose size is that of the vocabulary (about 1 MB for 50,000 tokens), read on the driver.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, tidied

#: Entries that a memo holds before it starts anew.
MEMO = 250_000
_LOAD = 4  # keys to a bucket of the perfect hash, on average


class PerfectHash:
    """Hash-and-displace over the tokens: no empty slot, no collision, one comparison per lookup."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // _LOAD)
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if n else []
        self.shift = [0] * self.buckets
        self.slots: list[int] = [-1] * n
        taken = np.zeros(n, bool)
        singles = []
        for g in sorted(groups, key=len, reverse=True):
            if len(g) == 1:
                singles.append(int(g[0]))
                continue
            d = 1
            while True:  # a block of displacements at a time
                tries = np.arange(d, d + 64, dtype=np.uint64)
                at = self._places(h[g][None, :], tries[:, None])
                row = np.sort(at, axis=1)
                good = np.flatnonzero((row[:, 1:] != row[:, :-1]).all(axis=1) & ~taken[at].any(axis=1))
                if good.size:
                    break
                d += 64
            at = at[good[0]]
            taken[at] = True
            self.shift[bucket[g[0]]] = d + int(good[0])
            for i, place in zip(g.tolist(), at.tolist(), strict=True):
                self.slots[place] = i
        # Keys alone in their bucket go straight to the slots that are left.
        for i, place in zip(singles, np.flatnonzero(~taken).tolist(), strict=True):
            self.shift[bucket[i]] = -place - 1
            self.slots[place] = i

    def _places(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = h ^ (d * np.uint64(0x9E3779B97F4A7C15))
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) % np.uint64(self.n)).astype(np.int64)

    def _place(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        return ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) % self.n

    def slot(self, key: bytes) -> int:
        """Position in the key list of the only key that can equal ``key``."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self.slots[-d - 1 if d < 0 else self._place(h, d)] if d else 0


class Vocabulary:
    """Tokens by rank, with the perfect hash over them."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.tokens = [base64.b64decode(t) for t, _ in pairs]
        self.ranks = [int(r) for _, r in pairs]
        self.pattern = pattern
        self.hash = PerfectHash(self.tokens)

    def by_rank(self) -> pa.Array:
        """Token bytes at the place of their rank, null where no token has it."""
        out = [None] * (max(self.ranks, default=-1) + 1)
        for r, t in zip(self.ranks, self.tokens, strict=True):
            out[r] = t
        return pa.array(out, pa.large_binary())

    def rank(self, piece: bytes) -> int | None:
        i = self.hash.slot(piece)
        return self.ranks[i] if self.tokens[i] == piece else None


def merge(piece: bytes, rank) -> list[int]:
    """Ranks of the tokens that ``piece`` merges into: least rank first, leftmost on ties.

    ``rank`` maps bytes to a rank or None. Parts form a doubly linked list over their first bytes; the
    heap holds (rank, first byte, byte after) of adjacent pairs, packed into one integer each, and an
    entry whose parts have changed meanwhile is skipped.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is merged away
    before = list(range(-1, n))
    bits = n.bit_length()
    low = (1 << bits) - 1
    pop, push = heapq.heappop, heapq.heappush
    heap = [
        ((r << bits | i) << bits) | i + 2 for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        top = pop(heap)
        stop, i = top & low, top >> bits & low
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[mid], end[i] = 0, stop
        if stop < n:
            before[stop] = i
            if (r := rank(piece[i : (k := end[stop])])) is not None:
                push(heap, ((r << bits | i) << bits) | k)
        if i and (r := rank(piece[(j := before[i]) : stop])) is not None:
            push(heap, ((r << bits | j) << bits) | stop)
    out, i = [], 0
    while i < n:
        out.append(rank(piece[i : end[i]]))
        i = end[i]
    return out


class _Pieces(dict):
    """Pre-token -> its ids, packed."""

    def __init__(self, vocabulary: Vocabulary):
        self.whole = vocabulary.rank
        self.pair = dict(zip(vocabulary.tokens, vocabulary.ranks, strict=True)).get  # of bytes being merged

    def __missing__(self, token: str) -> bytes:
        raw = token.encode("utf-8")
        if (r := self.whole(raw)) is not None:
            out = pack("<i", r)
        else:
            ids = merge(raw, self.pair)
            out = pack(f"<{len(ids)}i", *ids)
        if len(raw) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[token] = out
        return out


class _Chunks(dict):
    """Text between two single spaces -> packed ids of the space and it; None where no cut may be made."""

    def __init__(self, pieces: _Pieces, pattern):
        self.pieces, self.find = pieces, pattern.findall

    def __missing__(self, chunk: str) -> bytes | None:
        # A cut before a space is exact when a non-blank follows it.
        if not chunk or chunk[0].isspace():
            return None
        out = b"".join(map(self.pieces.__getitem__, self.find(" " + chunk)))
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = out
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        pattern = regex.compile(vocabulary.pattern)
        self.find = pattern.findall
        self.pieces = _Pieces(vocabulary)
        self.chunks = _Chunks(self.pieces, pattern)

    def packed(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text. Each distinct chunk of the column is looked up once; texts with a blank that no
        chunk may begin with are matched as a whole."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        cut = pc.split_pattern(texts, " ")
        ends = cut.offsets.to_numpy().astype(np.int64)
        parts, ends = cut.values.slice(ends[0], ends[-1] - ends[0]), ends - ends[0]
        n = len(texts)
        heads = np.zeros(len(parts), bool)
        heads[ends[:-1]] = True
        known = parts.filter(pa.array(~heads)).dictionary_encode()
        table = list(map(self.chunks.__getitem__, known.dictionary.to_pylist()))
        code = np.empty(len(parts), np.int64)
        code[~heads] = known.indices.to_numpy()
        code[heads] = len(table) + np.arange(n)
        solid = np.array([x is not None for x in table] + [True] * n, bool)
        cuttable = np.logical_and.reduceat(solid[code], ends[:-1]) if n else solid
        nothing = len(table) + n
        for i, head in enumerate(parts.take(pa.array(ends[:-1])).to_pylist()):
            if not cuttable[i]:
                code[ends[i] + 1 : ends[i + 1]] = nothing
                head = texts[i].as_py()
            table.append(self.packed(head) if head else b"")
        table.append(b"")
        out = pa.array(table, pa.large_binary()).take(pa.array(code))
        at = np.frombuffer(out.buffers()[1], np.int64)[: len(code) + 1] // 4
        ids = np.frombuffer(out.buffers()[2] or b"", np.int32)[: at[-1]] if len(code) else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(at[ends].astype(np.int32)), pa.array(ids))


_shipped: dict[tuple, object] = {}


def load(spark: SparkSession, path: str, pattern: str):
    """Broadcast vocabulary; built once per application and vocabulary."""
    key = (spark.sparkContext.applicationId, path, pattern)
    if key not in _shipped:
        _shipped[key] = spark.sparkContext.broadcast(Vocabulary(path, pattern))
    return _shipped[key]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` array<int>: the tokens of the whole ``text``, no special tokens.

    Null and empty text have no ids; they stay rows. A column named ids is replaced; all others, clashing
    names and repeated rows included, pass through as they are. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = load(spark, path, pattern)

    @F.arrow_udf("array<int>")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shipped.value)  # its memos end with the task: reused workers run other stages too
        for part in parts:
            yield encoder.column(part)

    return docs.withColumn("ids", ids(F.col("text").cast("string")))


def _decoded(tokens: pa.Array, part: pa.Array) -> pa.Array:
    """The bytes of every list of ids of ``part`` (null: no bytes); ``tokens`` by rank."""
    flat, sizes = part.flatten(), pc.fill_null(pc.list_value_length(part), 0).to_numpy()
    if flat.null_count or (out := tokens.take(flat)).null_count:
        raise ValueError("unknown token id")
    at = np.frombuffer(out.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    ends = pa.py_buffer(at[np.cumsum([0, *sizes], dtype=np.int64)])
    text = pa.Array.from_buffers(pa.large_binary(), len(part), [None, ends, out.buffers()[2] or pa.py_buffer(b"")])
    return text.cast(pa.binary())


def decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``decoded`` binary: the bytes of ``ids`` (null ids: no bytes). Unknown ids raise an error."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = load(spark, path, pattern)

    @F.arrow_udf("binary")
    def raw(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = shipped.value.by_rank()
        for part in parts:
            yield _decoded(tokens, part)

    return docs.withColumn("decoded", raw(F.col("ids")))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task: two in a row would each hold a vocabulary."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shipped = load(spark, path, pattern)

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tidied()
        encoder, tokens = Encoder(shipped.value), shipped.value.by_rank()
        for part in parts:
            ids = encoder.column(part)
            yield pa.StructArray.from_arrays([ids, _decoded(tokens, ids)], ["ids", "decoded"])

    out = docs.drop("ids", "decoded").withColumn("round_trip", both(F.col("text").cast("string")))
    return out.select(*(c for c in out.columns if c != "round_trip"), "round_trip.ids", "round_trip.decoded")


def ids_text(ids):
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
