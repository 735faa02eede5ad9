"""String similarity scores from 0 to 100, after the longest common subsequence.

The scores are Python on Arrow batches: each distinct pair of a batch is scored once, all pairs of a batch together
(see ``subsequence``). ``all_scores`` gives the four scores of a field in one transfer. Scores match the public
definitions of the usual fuzzy-matching library; nothing is normalized here. A null side gives null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kindred.functions.subsequence import best_window_ratios, lcs_lengths


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Twice the common subsequence over the summed lengths; both empty: 100."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], float)
    return np.where(total > 0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1), 100.0)


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sorts(a: list[str], b: list[str]) -> np.ndarray:
    """Ratio of the tokens in order."""
    return ratios(list(map(_sorted, a)), list(map(_sorted, b)))


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """Best of the scores among shared tokens, and shared tokens with either side's rest; 0 without tokens on a side."""
    sets = [(set(x.split()), set(y.split())) for x, y in zip(a, b, strict=True)]
    parts = [tuple(" ".join(sorted(z)) for z in (x & y, x - y, y - x)) for x, y in sets]
    shared, nx, ny = (np.array([len(p[i]) for p in parts], float) for i in range(3))
    common = lcs_lengths([p[1] for p in parts], [p[2] for p in parts])
    gap = (shared > 0).astype(float)
    left, right = shared + gap + nx, shared + gap + ny
    best = 100 * (1 - (nx + ny - 2 * common) / np.maximum(left + right, 1))
    for n, side in ((nx, left), (ny, right)):
        best = np.maximum(best, np.where(shared > 0, 100 * (1 - (gap + n) / np.maximum(shared + side, 1)), 0.0))
    best = np.where((shared > 0) & ((nx == 0) | (ny == 0)), 100.0, best)
    return np.where([bool(x) and bool(y) for x, y in sets], best, 0.0)


def best_of_three(a: list[str], b: list[str]) -> np.ndarray:
    """Greatest of ratio, partial ratio and token set ratio."""
    return np.maximum(np.maximum(ratios(a, b), token_sets(a, b)), best_window_ratios(a, b))


def ratio_of(a: str, b: str) -> float:
    return float(ratios([a], [b])[0])


def partial_ratio_of(a: str, b: str) -> float:
    return float(best_window_ratios([a], [b])[0])


def token_set_ratio_of(a: str, b: str) -> float:
    return float(token_sets([a], [b])[0])


def _distinct(a: pa.Array, b: pa.Array) -> tuple[list[str], list[str], np.ndarray]:
    """Distinct pairs of two columns, and the place of each row's pair among them (-1: a side is null)."""
    places: dict[tuple[str, str], int] = {}
    at = np.empty(len(a), np.int64)
    for i, pair in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True)):
        at[i] = -1 if pair[0] is None or pair[1] is None else places.setdefault(pair, len(places))
    return [p[0] for p in places], [p[1] for p in places], at


def _spread(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array(np.append(values, 0.0)[at], pa.float64(), mask=at < 0)


def _udf(score):
    @F.arrow_udf(DoubleType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y, at = _distinct(a, b)
        return _spread(score(x, y), at)

    return run


ratio = _udf(ratios)
partial_ratio = _udf(best_window_ratios)
token_sort_ratio = _udf(token_sorts)
token_set_ratio = _udf(token_sets)
best_ratio = _udf(best_of_three)

SCORES = {"ratio": ratios, "partial_ratio": best_window_ratios, "token_sort": token_sorts, "token_set": token_sets}


@F.arrow_udf(StructType([StructField(s, DoubleType()) for s in SCORES]))
def all_scores(a: pa.Array, b: pa.Array) -> pa.Array:
    """The four scores of a pair of strings."""
    x, y, at = _distinct(a, b)
    return pa.StructArray.from_arrays([_spread(score(x, y), at) for score in SCORES.values()], names=list(SCORES))


def similarity(score: Column, a: Column, b: Column) -> Column:
    """``score`` of ``a`` and ``b`` over 100; 0 where either side is empty."""
    return F.when((a == "") | (b == ""), 0.0).otherwise(score / 100)


def length_ratio(a: Column, b: Column) -> Column:
    """Shorter over longer length; 0 where either is empty."""
    x, y = F.length(a), F.length(b)
    return F.when((x == 0) | (y == 0), 0.0).otherwise(F.least(x, y) / F.greatest(x, y))


def length_ratio_or_one(a: Column, b: Column) -> Column:
    """As ``length_ratio``, but 1 where both are empty."""
    return F.when((a == "") & (b == ""), 1.0).otherwise(length_ratio(a, b))


def _overlap(a: Column, b: Column, below) -> Column:
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.size(F.array_intersect(a, b)) / below)
    )


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of token arrays; both empty: 1."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    return _overlap(a, b, F.size(F.array_union(a, b)))


def number_overlap(a: Column, b: Column) -> Column:
    """Shared numbers over the larger set; both empty: 1."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    return _overlap(a, b, F.greatest(F.size(a), F.size(b)))


def entity_f_half(tp: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of one entity from counts; both sets empty: 1, one empty: 0."""
    p, r = tp / predicted, tp / true
    return (
        F.when((predicted == 0) & (true == 0), 1.0)
        .when((predicted == 0) | (true == 0) | (tp == 0), 0.0)
        .otherwise(1.25 * p * r / (0.25 * p + r))
    )


def register(spark: SparkSession) -> None:
    """The scores and the basic normalizer as SQL functions."""

    @F.arrow_udf(StringType())
    def basic(values: pa.Array) -> pa.Array:
        return pa.array([normalize_basic_of(v) for v in values.to_pylist()], pa.string())

    for name, f in (("fuzz_ratio", ratio), ("fuzz_partial_ratio", partial_ratio), ("fuzz_token_sort_ratio", token_sort_ratio),
                    ("fuzz_token_set_ratio", token_set_ratio), ("normalize_text", basic)):
        spark.udf.register(name, f)


def normalize_basic_of(value: str | None) -> str:
    import re
    import unicodedata

    plain = unicodedata.normalize("NFKD", (value or "").lower().strip())
    return re.sub("[^a-z0-9]+", " ", re.sub(r"[^\x00-\x7f]", "", plain)).strip()
