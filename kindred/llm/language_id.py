"""Language ID: blended-spectrum presence kernels, Nystroem landmarks, one-versus-rest kernel ridge regression.

k(x, y) is the mean over n of |G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|), where G_n are the distinct byte
n-grams of the lower-cased letters of the whole text. The classifier sees only the text.

Scale: the fit uses a bounded sample on the driver: ``per_class`` labelled rows of each label, chosen by hash in two
levels on ids alone, and of those as many as fit into ``sample_chars`` characters. The model is a few MB and is broadcast. Scoring
is one narrow pass: a batch of presence rows times the landmark matrix, times the ridge weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import bounded_batches, tidied, written

UNKNOWN = "und"
ORDERS = (1, 2, 3)
_BATCH = 256


#: What is no letter and no mark on one: vowel signs belong to their letters.
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
#: The same for the characters of most texts, from a table of the code points below 0x250.
_LATIN = {c: " " for c in range(0x250) if not chr(c).isalpha()}
_BEYOND = regex.compile("[^\x00-\u024f]")


def letters(text: str) -> str:
    """Lower-cased letters with their marks; runs of all else are one space, one stands at either end."""
    text = text.lower()
    text = _OTHER.sub(" ", text) if _BEYOND.search(text) else text.translate(_LATIN)
    return f" {' '.join(text.split())} "


def _codes(text: str) -> list[np.ndarray]:
    """Codes of the 1- to 3-grams of the text's letters."""
    raw = np.frombuffer(letters(text).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int32)
    two = raw[:-1] << 8 | raw[1:]
    three = two[:-1] << 8 | raw[2:]
    return [raw, two, three]


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


class Spectrum:
    """Fixed list of n-grams (those of the landmarks) and the presence rows over it."""

    def __init__(self, grams: list[np.ndarray]):
        self.grams = grams
        self.widths = [g.size for g in grams]
        self.tables: list[np.ndarray] | None = None

    def __getstate__(self):
        return {"grams": self.grams, "widths": self.widths, "tables": None}

    def lookup(self) -> list[np.ndarray]:
        if self.tables is None:
            self.tables = []
            for n, g in zip(ORDERS, self.grams, strict=True):
                table = np.full(1 << 8 * n, g.size, np.int32 if g.size > 32_000 else np.int16)
                table[g] = np.arange(g.size)
                self.tables.append(table)
        return self.tables

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """Per order, presence scaled by 1/sqrt of the text's own number of distinct n-grams."""
        out = [np.zeros((len(texts), w + 1), np.float32) for w in self.widths]
        seen = [np.zeros(1 << 8 * n, bool) for n in ORDERS]
        for i, text in enumerate(texts):
            for codes, table, row, mark in zip(_codes(text), self.lookup(), out, seen, strict=True):
                row[i, table[codes]] = 1.0
                mark[codes] = True  # count distinct codes without sorting them
                distinct = self._count(codes, mark)
                row[i, :-1] /= np.sqrt(max(1, distinct))
        return [x[:, :-1] for x in out]

    @staticmethod
    def _count(codes: np.ndarray, mark: np.ndarray) -> int:
        """Distinct codes; every mark is cleared again."""
        n = 0
        for at in range(0, codes.size, 1 << 16):
            part = codes[at : at + (1 << 16)]
            first = np.unique(part[mark[part]])
            n += first.size
            mark[first] = False
        return n


class Model:
    """Landmark matrix by order, and ridge weights by class."""

    def __init__(self, texts: list[str], labels: list[str], landmarks: int, ridge: float, seed: int):
        self.classes = sorted(set(labels))
        rng = np.random.default_rng(seed)
        picked: list[int] = []
        for c in self.classes:  # the same number from each class
            own = [i for i, x in enumerate(labels) if x == c]
            picked += rng.permutation(own)[: max(1, landmarks // len(self.classes))].tolist()
        marks = [texts[i] for i in picked]
        grams = [np.unique(np.concatenate(g)) for g in zip(*map(_codes, marks), strict=True)]
        self.spectrum = Spectrum(grams)
        self.landmarks = [np.ascontiguousarray(x.T) for x in self.spectrum.rows(marks)]
        among = self.kernel(marks)
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        keep = values > 1e-6 * values.max()
        self.root = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float64)
        z = np.hstack([self.kernel(texts) @ self.root, np.ones((len(texts), 1))])
        goal = np.array([[1.0 if x == c else -1.0 for c in self.classes] for x in labels])
        share = np.array([labels.count(c) for c in self.classes])
        weight = np.array([1.0 / share[self.classes.index(x)] for x in labels])[:, None] * len(labels) / len(self.classes)
        penalty = ridge * np.eye(z.shape[1])
        penalty[-1, -1] = 0
        self.weights = np.linalg.solve(z.T @ (weight * z) + penalty, z.T @ (weight * goal))
        self.fold = self.root @ self.weights[:-1]

    def kernel(self, texts: list[str]) -> np.ndarray:
        parts = []
        for i in range(0, len(texts), _BATCH):
            rows = self.spectrum.rows(texts[i : i + _BATCH])
            parts.append(sum(r @ m for r, m in zip(rows, self.landmarks, strict=True)).astype(np.float64) / len(ORDERS))
        return np.concatenate(parts) if parts else np.empty((0, self.landmarks[0].shape[1]))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not texts:
            return [], np.empty(0)
        value = self.kernel(texts) @ self.fold + self.weights[-1]
        best = value.argmax(axis=1)
        e = np.exp(4 * (value - value.max(axis=1, keepdims=True)))
        return [self.classes[i] for i in best], 1 / e.sum(axis=1)


def fit(
    labelled: DataFrame, per_class: int = 400, max_classes: int = 1000, landmarks: int = 160, ridge: float = 0.1, sample_chars: int = 64_000_000, seed: int = 7
) -> Model | None:
    """Model of (doc_id, text, lang) rows; null with no labelled text that has a letter. Other columns are not read.

    Bounds of the sample: ``per_class`` rows of each label (least digest of id and text), and of those, turn by turn through the
    labels, as many as have ``sample_chars`` characters together; the first row of each label always counts. More than
    ``max_classes`` labels raise an error: none may silently never be named. Rows with a null text or label, or without a letter, teach
    nothing; repeated rows count once each; a label named ``und`` is no language.
    """
    rows = labelled.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    rows = rows.where(F.col("lang") != UNKNOWN).select(F.col("doc_id").cast("string").alias("id"), "lang", F.col("text").cast("string").alias("text"))
    digest = F.md5(F.concat(F.coalesce("id", F.lit("")), F.lit("|"), F.md5("text")))
    narrow = rows.select("lang", digest.alias("digest"), F.char_length("text").alias("n"))
    # Two levels: the least digests of each part of a label, then of the label.
    part = F.pmod(F.xxhash64("digest"), F.lit(64))
    first = Window.partitionBy("lang", "part").orderBy("digest")
    few = narrow.withColumn("part", part).withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= per_class)
    few = few.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("digest"))).where(F.col("turn") <= per_class)
    few = written(few.select("lang", "digest", "n", "turn"), "sample")
    if few.select("lang").distinct().limit(max_classes + 1).count() > max_classes:
        raise ValueError(f"more than {max_classes} labels")
    upto = F.sum("n").over(Window.orderBy("turn", "lang"))  # a sample: max_classes * per_class narrow rows at most
    ids = few.withColumn("upto", upto).where((F.col("upto") <= sample_chars) | (F.col("turn") == 1)).select("digest")
    sample = rows.withColumn("digest", digest).join(F.broadcast(ids), "digest", "left_semi").dropDuplicates(["digest", "lang"])
    sample = sample.select("text", "lang").toPandas().sort_values(["lang", "text"])
    if not len(sample):
        return None
    return Model(sample["text"].tolist(), sample["lang"].tolist(), landmarks, ridge, seed)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` string and ``score`` double in [0, 1]; other columns pass through.

    ``und`` with score 0 where the text is null or has no letter, or where there is no model. Columns of the
    two names are replaced. Texts are scored whole. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def name(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tidied()
        m = shipped.value
        for part in parts:
            texts = part.to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if m is not None and has_letter(t)]
            for at in range(0, len(known), _BATCH):
                own = known[at : at + _BATCH]
                found, value = m.predict([texts[i] for i in own])
                scores[own] = value
                for i, x in zip(own, found, strict=True):
                    langs[i] = x
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    # The caller's columns ride in a struct, whatever they are called.
    out = docs.select(F.struct(*kept).alias("row") if kept else F.lit(None).alias("row"), name(F.col("text").cast("string")).alias("named"))
    return out.select(*([F.col("row.*")] if kept else []), "named.lang_pred", "named.score")


def held_out(doc_id):
    """True for the third of ids that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
