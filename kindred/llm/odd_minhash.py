"""MinHash near-duplicate groups, with odd sketches in front of the exact check.

Every text becomes 128 MinHash samples of its five-word shingles. Bands of four samples propose
candidates; a 512-bit *odd sketch* (the parity of how many samples fall on each bit; Mitzenmacher,
Pagh and Pham, 2014) estimates a candidate's similarity from the population count of an XOR, which is
sharp just where similarities are high; what it leaves is confirmed on the full shingle sets.
A second odd sketch folds the shingle set itself into 1,024 bits: two of them never differ in more bits than
the sets differ in shingles, so it rejects pairs of short and middling texts without losing a link.

Scale: exact copies collapse to one representative before any band is built; a band's bucket is
compared with its smallest member first (a star, never all pairs); members that the star left in another
component meet their bucket's best-known member, and what is still outside meets the rest of the
bucket, behind the sketches. Only texts of pairs that pass both sketches move: a bitmap of their ids drops
the others where they are read, and each goes to the blocks of at most about ``TOGETHER`` members in which a
leader is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, components, roughly_among, tidied, written
from kindred.llm.texthash import U, mix, seeds, shingles, words

SAMPLES, ROWS, SKETCH_WORDS = 128, 4, 8
_BITS = 64 * SKETCH_WORDS
#: 64-bit words of the odd sketch of the whole set.
SET_WORDS = 16
#: Members compared with one copy of their leader's text.
TOGETHER = 256
#: Rounds in which an element draws its sample at random; samples still empty then see every element.
_ROUNDS = 16
_SEED, _REST = seeds(_ROUNDS, 1), seeds(SAMPLES, 2)
_PLACE, _BAND = seeds(SAMPLES, 3), seeds(SAMPLES // ROWS, 4)
_ODD, _SET = [f"o{i}" for i in range(SKETCH_WORDS)], [f"s{i}" for i in range(SET_WORDS)]


def samples(grams: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set by fast similarity sketching (Dahlgaard et al., 2017)."""
    out = np.zeros(SAMPLES, U)
    empty = np.ones(SAMPLES, bool)
    shift = U(64 - (SAMPLES - 1).bit_length())
    for t in range(_ROUNDS):
        h = np.sort(mix(grams ^ _SEED[t]))
        place = (h >> shift).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        first = first[empty[place[first]]]
        out[place[first]] = h[first] + U(t)
        empty[place[first]] = False
        if not empty.any():
            return out
    rest = np.flatnonzero(empty)
    for i in rest:
        out[i] = mix(grams ^ _REST[i]).min()
    return out


def odd_sketch(values: np.ndarray) -> np.ndarray:
    place = mix(values ^ _PLACE) % U(_BITS)
    odd = np.bincount(place.astype(np.int64), minlength=_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_sketch(grams: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each bit; the fingerprints are mixed already."""
    bits = 64 * SET_WORDS
    odd = np.bincount((grams % U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketch_limit(similarity: float, sigmas: float = 5.0) -> int:
    """Most differing bits that a pair at ``similarity`` shows, but for ``sigmas`` standard deviations."""
    spread = sigmas * (SAMPLES * similarity * (1 - similarity)) ** 0.5
    low = max(0.0, similarity - spread / SAMPLES)
    gone = 2 * SAMPLES * (1 - low)
    return int(_BITS / 2 * (1 - (1 - 2 / _BITS) ** gone) + sigmas * 2)


_SIGNED = "doc_id long, d1 long, d2 long, n_shingles long, bands array<long>, " + ", ".join(f"{o} long" for o in _ODD + _SET)


def _digest(w: np.ndarray) -> tuple[int, int]:
    """Both halves of a 128-bit digest of the word sequence, as signed numbers."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(w.tobytes()), np.int64).tolist())


def _sign(shingle: int):
    names = ["doc_id", "d1", "d2", "n_shingles", "bands", *_ODD, *_SET]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidied()
        for batch in batches:
            digests, sizes, bands, odd = [], [], [], []
            for text in batch.column(1).to_pylist():
                w = words(text)[0]
                grams = shingles(w, shingle)
                digests.append(_digest(w) if w.size else (None, None))
                sizes.append(grams.size)
                if grams.size:
                    s = samples(grams)
                    odd.append(np.concatenate([odd_sketch(s), set_sketch(grams)]))
                    keys = (s * _PLACE).reshape(-1, ROWS).sum(axis=1, dtype=U)
                    bands.append(mix(keys ^ _BAND).view(np.int64))
                else:
                    odd.append(np.zeros(SKETCH_WORDS + SET_WORDS, np.int64))
                    bands.append(np.empty(0, np.int64))
            flat = np.concatenate([*bands, np.empty(0, np.int64)])
            ends = np.cumsum([0, *(len(b) for b in bands)], dtype=np.int32)
            odds = np.stack(odd) if odd else np.empty((0, SKETCH_WORDS + SET_WORDS), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    *(pa.array(odds[:, i].copy()) for i in range(odds.shape[1])),
                ],
                names=names,
            )

    return run


def _confirm(shingle: int, percent: int):
    """Links of leaders with members whose full sets have 100 * |A & B| >= percent * |A | B|.

    Rows come sorted by leader and block, the leader's text first. A text with another digest than the
    one that was signed is another row of the same id and is passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidied()
        held, lead = None, None
        for batch in batches:
            found = []
            for doc, leader, block, member, d1, d2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if member and (leader, block) != held:
                    continue  # the leader's signed text comes first, wherever it exists
                w = words(text)[0]
                if not w.size or _digest(w) != (d1, d2):
                    continue
                x = shingles(w, shingle)
                if not member:
                    held, lead = (leader, block), x
                    continue
                both = np.intersect1d(x, lead, assume_unique=True).size
                if 100 * both >= percent * (x.size + lead.size - both):
                    found.append((doc, leader))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, similarity_percent: int = 75, shingle: int = 5) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of ``similarity_percent`` or more.

    docs: ``doc_id`` and ``text``; further columns, whatever their names, are not read.
    Returns one row per distinct doc_id: ``doc_id, n_shingles, component_id, kept``.

    Null or empty text, and text without words: an empty set, linked with nothing, kept. Rows that
    repeat an id count once (of differing texts, the one with the smallest digest). A null id: its
    rows fold into one row of null id that is linked with nothing. Ties go to the smallest doc_id.
    An empty table gives no rows. Sets hold 64-bit fingerprints of the shingles of the whole text.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(docs.mapInArrow(_sign(shingle), _SIGNED).withColumn("row", F.monotonically_increasing_id()), "signed")

    full = signed.where("d1 is not null and doc_id is not null")
    once = full.groupBy("doc_id").agg(F.min(F.struct("d1", "d2", "row", "n_shingles")).alias("s"))
    members = written(once.select("doc_id", "s.d1", "s.d2", "s.row", "s.n_shingles"), "members")
    # A table of its own, so that the joins with it can split a digest that very many copies share.
    classes = members.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "row")).alias("m"))
    classes = written(classes.select("d1", "d2", F.col("m.doc_id").alias("rep"), "m.row"), "classes")
    reps = written(signed.join(classes.select("row"), "row", "left_semi").drop("row", "d1", "d2"), "representatives")

    entries = reps.select("doc_id", F.explode("bands").alias("band"))
    stars = entries.groupBy("band").agg(F.min("doc_id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    crowded = written(entries.join(stars.select("band", "leader", "n"), "band"), "buckets")
    # Who shares the most buckets with the most others: the text that near copies were made from stands out.
    fame = crowded.groupBy("doc_id").agg(F.sum("n").alias("fame"))
    crowded = written(crowded.select("band", "doc_id", "leader").join(fame, "doc_id"), "known")

    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), *(F.col(o).alias(f"a{o}") for o in _ODD + _SET))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), *(F.col(o).alias(f"b{o}") for o in _ODD + _SET))
    differ, apart = (
        sum((F.bit_count(F.col(f"a{o}").bitwiseXOR(F.col(f"b{o}"))) for o in sketch), F.lit(0)) for sketch in (_ODD, _SET))
    alike = (
        (100 * F.least("na", "nb") >= similarity_percent * F.greatest("na", "nb"))
        & (differ <= sketch_limit(similarity_percent / 100))
        # A link's sets differ in (100 - p) / (100 + p) of their summed sizes at most, their sketches in no more bits.
        & ((100 + similarity_percent) * apart <= (100 - similarity_percent) * (F.col("na") + F.col("nb")))
    )
    signs = members.select("doc_id", "d1", "d2")

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        """Links among the written ``pairs(a, b)``, b the leader. Reads the texts of their documents alone."""
        large = written(pairs.groupBy("b").agg(F.count("*").alias("n")).where(F.col("n") > TOGETHER), f"{label}-large")
        block = F.pmod(F.xxhash64("a"), F.coalesce(F.ceil(F.col("n") / TOGETHER), F.lit(1)))
        dealt = pairs.join(large, "b", "left").select("a", "b", block.alias("block"))
        asked = dealt.select(F.col("a").alias("doc_id"), F.col("b").alias("leader"), "block", F.lit(True).alias("member"))
        asked = asked.unionByName(dealt.select(F.col("b").alias("doc_id"), F.col("b").alias("leader"), "block", F.lit(False).alias("member")).distinct())
        asked = written(asked.join(signs, "doc_id"), f"{label}-asked")
        texts = roughly_among(docs, asked.select("doc_id"), "doc_id").join(asked, "doc_id")
        texts = texts.repartition("leader", "block").sortWithinPartitions("leader", "block", "member")
        texts = texts.select("doc_id", "leader", "block", "member", "d1", "d2", "text")
        return written(texts.mapInArrow(_confirm(shingle, similarity_percent), "a long, b long"), label)

    spokes = crowded.where("doc_id <> leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).distinct()
    spokes = written(spokes.join(left, "a").join(right, "b").where(alike).select("a", "b"), "spokes")
    first = verified(spokes, "links-1")

    # Buckets whose members the stars left in several components. Those outside a bucket's most common
    # component first meet the bucket's best-known member; those still outside then meet all others of
    # the bucket, so that no link is lost behind a leader or a hub.
    def mixed(links: DataFrame, label: str) -> DataFrame:
        found = components(links, label)
        known = crowded.select("band", "doc_id", "fame").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        known = known.select("band", "doc_id", "fame", F.coalesce("component", "doc_id").alias("component"))
        sizes = known.groupBy("band", "component").agg(F.count("*").alias("n"), F.max(F.struct("fame", "doc_id", "component")).alias("hub"))
        main = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.max("hub").alias("hub"), F.count("*").alias("parts"))
        main = main.where("parts > 1").select("band", F.col("top.component").alias("main"), F.col("hub.doc_id").alias("hub"), F.col("hub.component").alias("hub_component"))
        return written(known.join(main, "band"), f"{label}-mixed")

    def sifted(pairs: DataFrame, done: list[DataFrame], label: str) -> DataFrame:
        """Distinct pairs, larger id first, without those already compared."""
        out = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        for d in done:
            out = out.join(d, ["a", "b"], "left_anti")
        return written(out, label)

    outside = mixed(first, "groups-1").where("component <> hub_component").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    hubs = sifted(outside.join(left, "a").join(right, "b").where(alike), [spokes], "hubs")
    second = verified(hubs, "links-2")

    rest = mixed(first.unionByName(second), "groups-2").drop("hub", "hub_component", "fame").join(reps.drop("bands"), "doc_id")
    own = lambda p: [F.col(x).alias(f"{p}{x}") for x in _ODD + _SET] + [F.col("doc_id").alias(p), F.col("component").alias(f"c{p}"), F.col("n_shingles").alias(f"n{p}")]
    odd = rest.where("component <> main").select("band", *own("a"))
    every = rest.select("band", *own("b"))
    # A pair comes out of each bucket that it shares; ``sifted`` folds these rows before any text is read.
    more = odd.join(every, "band").where((F.col("ca") != F.col("cb")) & alike)
    more = sifted(more, [spokes, hubs], "more")
    third = verified(more, "links-3")
    groups = written(components(first.unionByName(second).unionByName(third), "groups-3").withColumnRenamed("node", "rep"), "groups")

    named = classes.join(groups, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    labelled = members.join(written(named, "named"), ["d1", "d2"]).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("d1 is null or doc_id is null").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    alone = alone.join(members, "doc_id", "left_anti").withColumn("component_id", F.col("doc_id"))
    out = labelled.unionByName(alone.select("doc_id", "n_shingles", "component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
