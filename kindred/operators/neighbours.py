"""Exact TF-IDF neighbours, block by block, for corpora whose pairs are too many to be shuffled.

Texts move, not weighted grams or pairs: every block of S1 records meets every block of the targets of a country and source,
beside the frequencies of that corpus' grams. A task scores all pairs of two blocks in single precision, the frequent grams by
a matrix product and the others along their postings; what may be among the best by the bound on that error is scored again in
double precision. Records with equal bags of words are scored once.

A gram of two to four characters is two numbers, of two code points each (none: 0).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.sources.stage import written

FIELDS = ("name", "address", "combined")
#: Records in a block, at least and at most for S1, and for targets.
LEAST, S1_BLOCK, TARGET_BLOCK = 2048, 16384, 32768
#: Scores held at once, grams that may go through the matrix product, and the share of pairs from which one does.
HELD, DENSE, SHARE = 4_000_000, 256, 1 / 1000
#: Characters whose grams a task counts together.
CHARACTERS = 2_000_000
#: Parts of a country's records that are counted apart.
_PARTS = 16
_FOUND = "country string, source string, field string, s1_id string, candidate_id string, score double"


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the word, high, low) of all grams of every word between two spaces, repeats kept."""
    padded = [f" {w} " if w else "" for w in words]
    c = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(words)), np.array([len(p) for p in padded], np.int64))
    out = []
    for n in (2, 3, 4):
        at = np.flatnonzero(row[: max(0, len(c) - n + 1)] == row[n - 1 :])
        low = c[at + 2] << 21 if n > 2 else np.zeros(len(at), np.int64)
        out.append((row[at], c[at] << 21 | c[at + 1], low | c[at + 3] if n > 3 else low))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(3))


def _field(field: str, name: pa.Array, address: pa.Array) -> pa.Array:
    return {"name": name, "address": address}.get(field) if field != "combined" else pc.binary_join_element_wise(name, address, " ")


def _bags(texts: pa.Array) -> pa.DictionaryArray:
    """Every text's words in order, since grams do not see where a word stands."""
    return pa.array([" ".join(sorted(t.split())) if t else "" for t in texts.to_pylist()], pa.large_string()).dictionary_encode()


def _flat(values) -> pa.Array:
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


class Corpus:
    """Grams of one corpus, with their weights."""

    def __init__(self, high: np.ndarray, low: np.ndarray, df: np.ndarray, n: int):
        self.highs, self.lows = np.unique(high), np.unique(low)
        code = np.searchsorted(self.highs, high) * len(self.lows) + np.searchsorted(self.lows, low)
        order = np.argsort(code)
        self.codes = code[order]
        self.idf = (np.log((1.0 + n) / (1.0 + df)) + 1.0)[order]

    def places(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Where each gram stands, -1 for others."""
        def of(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            return at, known[at] == wanted

        (a, has_a), (b, has_b) = of(self.highs, high), of(self.lows, low)
        at, has = of(self.codes, a * len(self.lows) + b)
        return np.where(has & has_a & has_b, at, -1)

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, places, weights) of every text, of unit length."""
        cut = pc.split_pattern(texts, " ")
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy())
        words = cut.flatten().dictionary_encode()
        code = words.indices.to_numpy().astype(np.int64)
        of, high, low = _grams(words.dictionary.to_pylist())
        at = self.places(high, low)
        of, at = of[at >= 0], at[at >= 0]
        order = np.argsort(of, kind="stable")
        begins, at = np.searchsorted(of[order], np.arange(len(words.dictionary) + 1)), at[order]
        n = np.diff(begins)[code]
        entry = np.arange(n.sum()) + np.repeat(begins[code] - np.cumsum(n) + n, n)
        key, tf = np.unique(np.repeat(row, n) * len(self.codes) + at[entry], return_counts=True)
        row, place = key // len(self.codes), key % len(self.codes)
        w = tf * self.idf[place]
        w /= np.sqrt(np.bincount(row, w * w, len(texts)))[row]
        return np.searchsorted(row, np.arange(len(texts) + 1)), place, w


def _ranges(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all ``rows`` one after the other, and where each row's begin."""
    n = starts[rows + 1] - starts[rows]
    begins = np.cumsum(n) - n
    return np.arange(n.sum()) + np.repeat(starts[rows] - begins, n), begins


def nearest(left, right, places: int, bound: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of ``left``, rows of ``right``, scores) of all scores >= ``bound`` that may be among the ``k`` best, ties included."""
    (l_starts, l_at, l_w), (r_starts, r_at, r_w) = left, right
    m, t = len(l_starts) - 1, len(r_starts) - 1
    # Sums of that many products of unit vectors in single precision are off by half of this at most.
    off = 2 * (1 + np.diff(l_starts).max(initial=0)) * 2.0**-22
    both = np.bincount(l_at, minlength=places).astype(float) * np.bincount(r_at, minlength=places)
    dense = np.argsort(-both, kind="stable")[: min(DENSE, 16_000_000 // max(t, 1))]
    dense = dense[both[dense] > SHARE * m * t]
    column = np.full(places, -1)
    column[dense] = np.arange(len(dense))

    def matrix(starts, at, w, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((hi - lo, len(dense)), np.float32)
        at, w = at[starts[lo] : starts[hi]], w[starts[lo] : starts[hi]]
        row = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
        own = column[at] >= 0
        out[row[own], column[at[own]]] = w[own]
        return out

    r_matrix = matrix(r_starts, r_at, r_w, 0, t).T
    r_row = np.repeat(np.arange(t), np.diff(r_starts))
    rare = np.flatnonzero(column[r_at] < 0)
    rare = rare[np.argsort(r_at[rare], kind="stable")]
    post, post_w = r_row[rare], r_w[rare].astype(np.float32)
    begins = np.searchsorted(r_at[rare], np.arange(places + 1))
    exact, step = np.zeros(places), max(1, HELD // max(t, 1))
    for lo in range(0, m, step):
        hi = min(m, lo + step)
        scores = matrix(l_starts, l_at, l_w, lo, hi) @ r_matrix
        for i in range(lo, hi):
            at, w, s = l_at[l_starts[i] : l_starts[i + 1]], l_w[l_starts[i] : l_starts[i + 1]], scores[i - lo]
            own = (column[at] < 0) & (begins[at + 1] > begins[at])
            for a, b, x in zip(begins[at[own]].tolist(), begins[at[own] + 1].tolist(), w[own].astype(np.float32), strict=True):
                s[post[a:b]] += x * post_w[a:b]
            hit = np.flatnonzero(s >= bound - off)
            if len(hit) > k:
                near = s[hit]
                hit = hit[near >= np.partition(near, len(near) - k)[len(near) - k] - off]
            if not len(hit):
                continue
            exact[at] = w
            entry, first = _ranges(r_starts, hit)
            score = np.add.reduceat(exact[r_at[entry]] * r_w[entry], first)
            exact[at] = 0
            yield i, hit[score >= bound], score[score >= bound]


def _meet(fields: tuple[str, ...], bounds: dict[str, float], k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        frequency = right.filter(pc.is_valid(right["field"]))
        right = right.filter(pc.is_null(right["field"])).sort_by("entity_id")
        out = {c: [] for c in ("field", "s1_id", "candidate_id", "score")}
        s1_ids, ids = _flat(left["entity_id"]), _flat(right["entity_id"])
        for field in fields if len(left) and len(right) else ():
            own = frequency.filter(pc.equal(frequency["field"], field))
            if not len(own):
                continue
            corpus = Corpus(*(own[c].to_numpy() for c in ("high", "low", "df")), own["n"][0].as_py())
            a, b = (_bags(_field(field, _flat(x["name"]), _flat(x["address"]))) for x in (left, right))
            a_of, b_of = a.indices.to_numpy(), b.indices.to_numpy()
            a_members, b_members = np.argsort(a_of, kind="stable"), np.argsort(b_of, kind="stable")
            a_begins, b_begins = (np.searchsorted(np.sort(x), np.arange(len(d.dictionary) + 1)) for x, d in ((a_of, a), (b_of, b)))
            lefts, rights, scores = [], [], []
            # Rows of the right side stand in the order of their least ids.
            for i, found, score in nearest(corpus.rows(a.dictionary), corpus.rows(b.dictionary), len(corpus.codes), bounds[field], k):
                best = np.lexsort((found, -np.round(score, 12)))[:k]
                found, score = found[best], score[best]
                n = np.minimum(b_begins[found + 1] - b_begins[found], k)
                at = b_members[np.repeat(b_begins[found] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                score = np.repeat(score, n)
                best = np.lexsort((at, -np.round(score, 12)))[:k]
                own_ids = a_members[a_begins[i] : a_begins[i + 1]]
                lefts.append(np.repeat(own_ids, len(best)))
                rights.append(np.tile(at[best], len(own_ids)))
                scores.append(np.tile(score[best], len(own_ids)))
            if lefts:
                lefts, rights, scores = (np.concatenate(x) for x in (lefts, rights, scores))
                out["field"].append(pa.array([field]).take(pa.array(np.zeros(len(lefts), np.int32))))
                out["s1_id"].append(s1_ids.take(pa.array(lefts)))
                out["candidate_id"].append(ids.take(pa.array(rights)))
                out["score"].append(pa.array(scores))
        rows = sum(map(len, out["score"]))
        same = {c: pa.array([x.as_py()], pa.string()).take(pa.array(np.zeros(rows, np.int32))) for c, x in zip(("country", "source"), key, strict=False)}
        kinds = {c: pa.float64() if c == "score" else pa.string() for c in out}
        return pa.table(same | {c: pa.chunked_array([y.cast(kinds[c]) for y in x], kinds[c]) for c, x in out.items()})

    return run


def _count(fields: tuple[str, ...]):
    def told(held: dict) -> Iterator[pa.RecordBatch]:
        for (country, source, field), parts in held.items():
            texts = pa.concat_arrays(parts)
            cut = pc.split_pattern(texts, " ")
            words = cut.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(texts)), pc.list_value_length(cut).to_numpy())
            of, high, low = _grams(words.dictionary.to_pylist())
            if not len(of):
                continue
            highs, lows = np.unique(high), np.unique(low)
            known, code = np.unique(np.searchsorted(highs, high) * len(lows) + np.searchsorted(lows, low), return_inverse=True)
            order = np.argsort(of, kind="stable")
            begins, code = np.searchsorted(of[order], np.arange(len(words.dictionary) + 1)), code[order]
            entry, _ = _ranges(begins, (at := words.indices.to_numpy().astype(np.int64)))
            row = np.repeat(row, np.diff(begins)[at])
            df = np.bincount(np.unique(row * len(known) + code[entry]) % len(known), minlength=len(known))
            for i in range(0, len(known), 100_000):
                part = known[i : i + 100_000]
                label = (pa.array([x] * len(part), pa.string()) for x in (country, source, field))
                yield pa.RecordBatch.from_arrays([*label, pa.array(highs[part // len(lows)]), pa.array(lows[part % len(lows)]), pa.array(df[i : i + 100_000])], ["country", "source", "field", "high", "low", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for batch in batches:
            for group in pa.table({c: batch[c] for c in ("country", "source")}).group_by(["country", "source"]).aggregate([]).to_pylist():
                same = pc.equal(batch["country"], group["country"])
                own = batch.filter(same if group["source"] is None else pc.and_(same, pc.equal(batch["source"], group["source"])))
                for field in fields:
                    texts = _field(field, own["name"], own["address"]).cast(pa.large_string())
                    held.setdefault((group["country"], group["source"], field), []).append(texts)
                    size += texts.nbytes
            if size > CHARACTERS:
                yield from told(held)
                held, size = {}, 0
        yield from told(held)

    return run


def neighbours(s1: DataFrame, others: DataFrame, fields=FIELDS, bound: float | dict[str, float] = 0.25, top_n: int = 30, min_df: int = 2) -> DataFrame:
    """(country, source, field, s1_id, candidate_id, score): the best ``top_n`` per S1 record, source and field with score >= ``bound``.

    The rows of ``tfidf.cosine_pairs(tfidf.weights(tfidf.corpora(...)))``, ties to the smaller id. Rows of one id count as one text.
    """
    spark, fields = s1.sparkSession, tuple(fields)
    bounds = bound if isinstance(bound, dict) else dict.fromkeys(fields, bound)
    if min(bounds.values()) <= 0:
        raise ValueError("a bound must be above 0")
    # At least as many tasks as there are partitions, wherever Spark would put so few bytes together.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def texts(records: DataFrame, source, label: str) -> DataFrame:
        words = lambda c: F.array_join(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda t: t != ""), " ").alias(c)
        part = F.pmod(F.xxhash64("entity_id"), F.lit(_PARTS)).alias("part")
        out = records.where("country is not null").select("country", source.alias("source"), part, "entity_id", words("name"), words("address"))
        out = out.repartition(partitions, "country", "source", "part").groupBy("country", "source", "part", "entity_id")
        return written(out.agg(F.count("*").alias("n"), *(F.array_join(F.collect_list(c), " ").alias(c) for c in ("name", "address"))), label)

    left = texts(s1, F.lit(None).cast("string"), "s1-texts")
    right = texts(others.where("entity_id is not null"), text.id_source("entity_id"), "target-texts")
    own = left.groupBy("country").agg(F.sum("n").alias("n1"), F.count("*").alias("m1"))
    sizes = right.groupBy("country", "source").agg(F.sum("n").alias("n"), F.count("*").alias("m")).join(own, "country")
    sizes = written(sizes.select("country", "source", (F.col("n") + F.col("n1")).alias("n"), "m", "m1"), "sizes")
    all_s1, most = sizes.agg(F.sum("m1"), F.max("m")).first()
    block = min(S1_BLOCK, max(LEAST, (all_s1 or 0) // (3 * partitions)))
    blocks = lambda c, size: F.ceil(F.col(c) / size).cast("int")
    grid = sizes.select("country", "source", "n", blocks("m1", block).alias("rows"), blocks("m", TARGET_BLOCK).alias("columns"))

    counted = lambda d: d.mapInArrow(_count(fields), "country string, source string, field string, high long, low long, df long")
    columns = ["country", "source", "name", "address"]
    of_s1 = counted(left.select(*columns)).drop("source").join(sizes.select("country", "source"), "country")
    df = of_s1.unionByName(counted(right.select(*columns))).groupBy("country", "source", "field", "high", "low").agg(F.sum("df").alias("df"))
    df = written(df.where(F.col("df") >= min_df), "frequencies")

    dealt = lambda c: F.pmod(F.xxhash64("entity_id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    key = ["country", "source", "row", "column"]
    a = left.where("entity_id is not null").drop("source").join(grid, "country").withColumn("row", dealt("rows")).withColumn("column", every("columns"))
    b = right.join(grid.drop("n"), ["country", "source"]).withColumn("column", dealt("columns")).withColumn("row", every("rows"))
    b = b.select(*key, "entity_id", "name", "address", *(F.lit(None).cast(t).alias(c) for c, t in (("field", "string"), ("high", "long"), ("low", "long"), ("df", "long"), ("n", "long"))))
    c = df.join(grid, ["country", "source"]).withColumn("column", every("columns")).withColumn("row", every("rows"))
    b = b.unionByName(c.select(*key, *(F.lit(None).cast("string").alias(x) for x in ("entity_id", "name", "address")), "field", "high", "low", "df", "n"))
    tasks = max(partitions, 64)
    cells = a.select(*key, "entity_id", "name", "address").repartition(tasks, *key).groupBy(*key).cogroup(b.repartition(tasks, *key).groupBy(*key))
    found = cells.applyInArrow(_meet(fields, bounds, top_n), _FOUND)
    if (most or 0) <= TARGET_BLOCK:
        return found
    turn = Window.partitionBy("country", "source", "field", "s1_id").orderBy(F.desc(F.round("score", 12)), "candidate_id")
    return found.withColumn("turn", F.row_number().over(turn)).where(F.col("turn") <= top_n).drop("turn")
