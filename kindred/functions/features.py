"""Feature columns of record pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import fuzzy, text

PAIR_COLUMNS = ("s1_business_name", "s1_business_address", "s1_country",
                "candidate_business_name", "candidate_business_address", "candidate_country")

# The names and order of the 16 features.
FEATURES_16 = (
    "name_ratio", "name_partial_ratio", "name_token_sort", "name_token_set", "name_exact", "name_length_ratio",
    "address_ratio", "address_partial_ratio", "address_token_sort", "address_token_set", "address_exact",
    "address_length_ratio", "same_country", "max_name_similarity", "max_address_similarity", "combined_similarity")

def features_16(pairs: DataFrame, normalized: bool = False) -> DataFrame:
    """``pairs`` with the 16 features as floats, computed in double and rounded once.

    Both empty counts as not exact; countries compare raw, empty equal to empty.
    """
    clean = (lambda c: F.coalesce(F.col(c), F.lit(""))) if normalized else text.normalize_basic
    held = [f"__{side}_{part}" for side in ("s1", "candidate") for part in ("name", "address")]
    out = pairs.withColumns({h: clean(h[2:].replace("_", "_business_", 1)) for h in held})
    # One transfer for all four scores of a field.
    out = out.withColumns({f"__{part}": fuzzy.all_scores(F.col(f"__s1_{part}"), F.col(f"__candidate_{part}")) for part in ("name", "address")})
    values, best = {}, {}
    for part in ("name", "address"):
        a, b = F.col(f"__s1_{part}"), F.col(f"__candidate_{part}")
        for label in fuzzy.SCORES:
            values[f"{part}_{label}"] = fuzzy.similarity(F.col(f"__{part}.{label}"), a, b)
        values[f"{part}_exact"] = ((a != "") & (a == b)).cast("double")
        values[f"{part}_length_ratio"] = fuzzy.length_ratio(a, b)
        best[part] = fuzzy.similarity(F.greatest(*(F.col(f"__{part}.{label}") for label in fuzzy.SCORES)), a, b)
        values[f"max_{part}_similarity"] = best[part]
    same = F.coalesce("s1_country", F.lit("")) == F.coalesce("candidate_country", F.lit(""))
    values["same_country"] = same.cast("double")
    values["combined_similarity"] = 0.6 * best["name"] + 0.4 * best["address"]
    return out.select(*pairs.columns, *(values[f].cast("float").alias(f) for f in FEATURES_16))


def features_26(pairs: DataFrame) -> DataFrame:
    """The extended row: 10 name, 11 address and 5 metadata features (Unicode normalization).

    Needs PAIR_COLUMNS, ``candidate_source``, ``retrieval_score`` and ``retrieval_rank``. Equal counts even where both sides
    are empty; the fuzzy scores have no guard, so empty meets empty at 100 for the two ratio cores.
    """
    held = {}
    for side in ("s1", "candidate"):
        held[f"__{side}_name"] = text.unicode_name(f"{side}_business_name")
        held[f"__{side}_address"] = text.unicode_address(f"{side}_business_address")
    out = pairs.withColumns(held)
    out = out.withColumns({f"{k}_ascii": text.remove_accents(k) for k in held})
    out = out.withColumns({f"__{part}": fuzzy.all_scores(F.col(f"__s1_{part}"), F.col(f"__candidate_{part}")) for part in ("name", "address")})
    names = []
    for part in ("name", "address"):
        a, b = F.col(f"__s1_{part}"), F.col(f"__candidate_{part}")
        score = lambda label: F.col(f"__{part}.{label}") / 100  # noqa: B023,E731
        values = {
            f"{part}1_missing": (a == "").cast("int"), f"{part}2_missing": (b == "").cast("int"),
            f"{part}_exact": (a == b).cast("int"),
            f"{part}_ascii_exact": (F.col(f"__s1_{part}_ascii") == F.col(f"__candidate_{part}_ascii")).cast("int"),
            f"{part}_ratio": score("ratio"), f"{part}_partial_ratio": score("partial_ratio"),
            f"{part}_token_sort_ratio": score("token_sort"), f"{part}_token_set_ratio": score("token_set"),
            f"{part}_token_jaccard": fuzzy.token_jaccard(text.tokens(a), text.tokens(b)),
        }
        if part == "address":
            values["address_number_overlap"] = fuzzy.number_overlap(text.numbers(a), text.numbers(b))
        values[f"{part}_length_ratio"] = fuzzy.length_ratio_or_one(a, b)
        out = out.withColumns(values)
        names += values
    c1, c2 = text.normalize_unicode("s1_country"), text.normalize_unicode("candidate_country")
    last = {
        "same_country": ((c1 != "") & (c1 == c2)).cast("int"),
        "candidate_is_s2": F.coalesce(F.col("candidate_source") == "S2", F.lit(False)).cast("int"),
        "candidate_is_s3": F.coalesce(F.col("candidate_source") == "S3", F.lit(False)).cast("int"),
        "__score": text.safe_number("retrieval_score"), "__rank": text.safe_number("retrieval_rank"),
    }
    out = out.withColumns(last)
    kept = [c for c in pairs.columns if c not in ("retrieval_score", "retrieval_rank")]
    return out.select(*kept, *names, "same_country", "candidate_is_s2", "candidate_is_s3",
                      F.col("__score").alias("retrieval_score"), F.col("__rank").alias("retrieval_rank"))


def missed_diagnostics(pairs: DataFrame) -> DataFrame:
    """``s1_id, candidate_id`` with the 4 name and 3 address scores (0 to 1) that tell why a true pair was missed.

    Needs PAIR_COLUMNS, normalized here. The address's best score leaves the sorted tokens out.
    """
    out = pairs.select("s1_id", "candidate_id", *(text.normalize_basic(f"{side}_business_{part}").alias(f"{side}_{part}") for side in ("s1", "candidate") for part in ("name", "address")))
    out = out.withColumns({f"__{part}": fuzzy.all_scores(F.col(f"s1_{part}"), F.col(f"candidate_{part}")) for part in ("name", "address")})
    values = []
    for part, labels in (("name", list(fuzzy.SCORES)), ("address", [x for x in fuzzy.SCORES if x != "token_sort"])):
        scores = [fuzzy.similarity(F.col(f"__{part}.{x}"), F.col(f"s1_{part}"), F.col(f"candidate_{part}")) for x in labels]
        values += [c.alias(f"{part}_{x}") for c, x in zip(scores, labels, strict=True)] + [F.greatest(*scores).alias(f"max_{part}")]
    return out.select("s1_id", "candidate_id", *values)


def rerank_scores(pairs: DataFrame) -> DataFrame:
    """``pairs`` of normalized texts with ``name_score`` and ``address_score``: best of ratio, partial and token set."""
    out = {}
    for part in ("name", "address"):
        a, b = F.col(f"s1_{part}"), F.col(f"candidate_{part}")
        out[f"{part}_score"] = fuzzy.similarity(fuzzy.best_ratio(a, b), a, b)
    return pairs.withColumns(out)
