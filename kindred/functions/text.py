"""Text normalization as column expressions; only Unicode decomposition leaves the JVM, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.arrow_udf(StringType())
def nfkd(values: pa.Array) -> pa.Array:
    return pc.utf8_normalize(values, form="NFKD")


@F.arrow_udf(StringType())
def _folded(values: pa.Array) -> pa.Array:
    """NFKC, full case folding, runs of white space to one space, trimmed."""
    fold = lambda v: " ".join(unicodedata.normalize("NFKC", v).casefold().split())
    return pa.array([None if v is None else fold(v) for v in values.to_pylist()], pa.string())


def _text(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def _spaced(col: Column, pattern: str) -> Column:
    return F.btrim(F.regexp_replace(col, pattern, " "))


def normalize_basic(col) -> Column:
    """Lower case, decompose, drop what is not ASCII, other characters to single spaces (null: empty).

    Lower-casing comes first, so capitals that the decomposition creates become spaces.
    """
    plain = F.regexp_replace(nfkd(F.lower(F.btrim(_text(col)))), r"[^\x00-\x7F]", "")
    return _spaced(plain, "[^a-z0-9]+")


def normalize_unicode(col) -> Column:
    return _folded(_text(col))


def remove_accents(col) -> Column:
    return F.regexp_replace(nfkd(_text(col)), r"\p{Mn}", "")


def unicode_name(col) -> Column:
    """Case-folded; ``&`` reads and; letters, digits and marks of any script stay."""
    return _spaced(F.regexp_replace(normalize_unicode(col), "&", " and "), r"[^\p{L}\p{N}\p{M}]+")


def unicode_address(col) -> Column:
    return _spaced(normalize_unicode(col), r"[^\p{L}\p{N}\p{M}-]+")


def unicode_name_ascii(col) -> Column:
    return remove_accents(unicode_name(col))


def unicode_address_ascii(col) -> Column:
    return remove_accents(unicode_address(col))


# Abbreviations that the blocking normalizer spells out.
NAME_WORDS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "inc": "incorporated", "co": "company",
              "llc": "llc", "llp": "llp", "plc": "plc"}
ADDRESS_WORDS = {"rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "apt": "apartment", "no": "number",
                 "flr": "floor", "bldg": "building", "dist": "district", "twp": "township"}


def _blocking(col, words: dict[str, str]) -> Column:
    plain = F.regexp_replace(nfkd(F.lower(_text(col))), r"\p{M}", "")
    plain = F.regexp_replace(plain, "&", " and ")
    plain = F.btrim(F.regexp_replace(F.regexp_replace(plain, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))
    long_form = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    return F.array_join(F.transform(F.split(plain, " "), lambda t: F.coalesce(F.try_element_at(long_form, t), t)), " ")


def blocking_name(col) -> Column:
    return _blocking(col, NAME_WORDS)


def blocking_address(col) -> Column:
    return _blocking(col, ADDRESS_WORDS)


def tokens(col) -> Column:
    """White-space separated tokens, in order."""
    return F.filter(F.split(_text(col), r"(?U)\s+"), lambda t: t != "")


def token_set(col) -> Column:
    return F.array_distinct(tokens(col))


def numbers(col) -> Column:
    """All runs of decimal digits of any script."""
    return F.regexp_extract_all(_text(col), F.lit(r"(?U)(\d+)"), F.lit(1))


def compact(col) -> Column:
    return F.replace(_text(col), F.lit(" "), F.lit(""))


def _windows(x: Column, n: int) -> Column:
    """All windows of ``n`` characters of ``x``; none where it is shorter."""
    # Bound as a lambda variable, the characters are split once and not for every window.
    of = lambda chars: F.when(F.size(chars) >= n, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(chars) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(chars, i, n), "")
    )).otherwise(F.array().cast("array<string>"))
    chars = F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ""))
    return F.transform(F.array(chars), of)[0]


def char_ngrams(col, *sizes: int) -> Column:
    """Distinct character n-grams of the compacted text; none where it is shorter than n."""
    return F.array_distinct(F.concat(*(_windows(compact(col), n) for n in sizes)))


def gram_bucket(country: Column, kind: Column, gram: Column, bits: int = 24) -> Column:
    """CRC-32 bucket of a gram within its country and kind."""
    return F.crc32(F.concat(country, kind, gram).cast("binary")).bitwiseAND(F.lit((1 << bits) - 1))


def word_boundary_grams(col, low: int = 2, high: int = 4) -> Column:
    """Grams (repeats kept) inside words padded by one space on both sides."""
    words = F.filter(F.split(F.lower(_text(col)), r"(?U)\s+"), lambda t: t != "")

    def of(word: Column) -> Column:
        return F.concat(*(_windows(F.concat(F.lit(" "), word, F.lit(" ")), n) for n in range(low, high + 1)))

    return F.flatten(F.transform(words, of))


def id_list(col) -> Column:
    """Distinct trimmed ids of a comma list, blanks dropped, first occurrence first (null: none)."""
    return F.array_distinct(F.filter(F.transform(F.split(_text(col), ","), lambda x: F.trim(x)), lambda x: x != ""))


def id_source(col) -> Column:
    return F.split_part(F.col(col) if isinstance(col, str) else col, F.lit("-"), F.lit(1))


def safe_number(col) -> Column:
    """As a double; 0 where it is null or no number."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string").try_cast("double"), F.lit(0.0))
