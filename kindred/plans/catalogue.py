"""Every operator as a query over the public test tables, with DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions import fuzzy, text
from kindred.functions.features import FEATURES_16, features_16, features_26, missed_diagnostics
from kindred.operators import blocking, evaluate, model, pairs, qa, rare, reports, tfidf
from kindred.plans import resolve
from kindred.plans.views import CUSTOMERS, DOCUMENTS, PARTS, view
from kindred.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Views:
    """The three sources of one entity view, raw and normalized."""

    def __init__(self, spark: SparkSession, sf_dir: str, of: dict[str, str]):
        self.spark, self.dir, self.of = spark, sf_dir, of

    def raw(self, name: str) -> DataFrame:
        return view(self.spark, self.dir, self.of[name])

    @property
    def s1(self) -> DataFrame:
        return resolve.normalized(self.raw("s1"))

    @property
    def targets(self) -> DataFrame:
        return blocking.targets(*(resolve.normalized(self.raw(n)) for n in ("s2", "s3")))

    @property
    def all_raw(self) -> DataFrame:
        return self.raw("s1").unionByName(self.raw("s2")).unionByName(self.raw("s3"))

    def pair_texts(self, found: DataFrame | None = None) -> DataFrame:
        """Candidate pairs with the raw texts of both records, as the feature operators want them."""
        found = self.raw("cand") if found is None else found
        side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{p}_{c}") for c in ("business_name", "business_address", "country")))
        others = self.raw("s2").unionByName(self.raw("s3"))
        both = found.join(side(self.raw("s1"), "s1", "s1_id"), "s1_id").join(side(others, "candidate", "candidate_id"), "candidate_id")
        # The tables are single files: without this, all pairs would be scored by as many tasks as the view has branches.
        return both.repartition(self.spark.sparkContext.defaultParallelism)

    def scored(self) -> DataFrame:
        """Pairs with the ratio of their normalized names as probability."""
        both = self.pair_texts()
        a, b = text.normalize_basic("s1_business_name"), text.normalize_basic("candidate_business_name")
        return both.select("s1_id", "candidate_id", (fuzzy.ratio(a, b) / 100).alias("match_probability"))


def query(of: dict[str, str] = CUSTOMERS, sql: str | None = None):
    def add(f: Callable[[Views], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir, of))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- SQL pieces -------------------------------------------------------------------------------------


def _n1(x: str) -> str:
    ascii_only = f"regexp_replace(strip_accents(lower(trim(coalesce({x}, '')))), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace({ascii_only}, '[^a-z0-9]+', ' ', 'g'))"


def _raw(of: dict[str, str]) -> str:
    return ", ".join(f"{name} as ({sql})" for name, sql in of.items())


def _views(of: dict[str, str] = CUSTOMERS) -> str:
    """The raw views, n1 (normalized S1) and nt (normalized targets)."""
    norm = lambda src: f"select entity_id, {_n1('business_name')} as name, {_n1('business_address')} as address, coalesce(country, '') as country from ({src})"
    return f"""with {_raw(of)}, n1 as ({norm('select * from s1')}),
nt as (select *, split_part(entity_id, '-', 1) as source from ({norm('select * from s2 union all select * from s3')})),
"""


_TRUE = """tp as (select source1_entity_id as s1_id, unnest(string_split(matched_entity_ids, ',')) as candidate_id from truth where matched_entity_ids <> '')"""


def _f05(tp: str = "tp", n_pred: str = "n_pred", n_true: str = "n_true") -> str:
    return (f"case when {n_pred} = 0 and {n_true} = 0 then 1.0 when {n_pred} = 0 or {n_true} = 0 or {tp} = 0 then 0.0 "
            f"else 1.25::double * ({tp}::double / {n_pred}) * ({tp}::double / {n_true}) / (0.25::double * ({tp}::double / {n_pred}) + ({tp}::double / {n_true})) end::double")


def _masks(a: str, b: str) -> str:
    """For every character of ``b``: at which places of ``a`` it stands, as the bits of a number (62 characters at most)."""
    bit = f"case when substr({a}, i::int, 1) = substr({b}, j::int, 1) then 1::bigint << (i - 1)::int else 0::bigint end"
    return f"list_transform(range(1, length({b}) + 1), lambda j: list_sum(list_transform(range(1, length({a}) + 1), lambda i: {bit}))::bigint)"


def _common(a: str, masks: str) -> str:
    """Longest common subsequence of ``a`` with the characters that the masks stand for."""
    full = f"((1::bigint << length({a})) - 1)"
    return f"(length({a}) - bit_count(list_reduce({masks}, lambda r, k: ((r + (r & k)) | (r - (r & k))) & {full}, {full})))"


def _lcs(a: str, b: str) -> str:
    return f"case when length({a}) = 0 or length({b}) = 0 then 0 else {_common(a, _masks(a, b))} end"


def _ratio(a: str, b: str) -> str:
    return f"case when length({a}) + length({b}) = 0 then 100.0 else 200.0::double * ({_lcs(a, b)}) / (length({a}) + length({b})) end::double"


def _set_ratio(ta: str, tb: str) -> str:
    """Token set ratio of two lists of distinct tokens."""
    return (f"list_transform([struct_pack(na := len({ta}), nb := len({tb}), i := array_to_string(list_sort(list_intersect({ta}, {tb})), ' '), "
            f"x := array_to_string(list_sort(list_filter({ta}, lambda t: not list_contains({tb}, t))), ' '), y := array_to_string(list_sort(list_filter({tb}, lambda t: not list_contains({ta}, t))), ' '))], "
            f"lambda p: case when p.na = 0 or p.nb = 0 then 0.0 when length(p.i) > 0 and (length(p.x) = 0 or length(p.y) = 0) then 100.0 else greatest("
            f"100 * (1 - (length(p.x) + length(p.y) - 2 * ({_lcs('p.x', 'p.y')}))::double / (2 * length(p.i) + 2 * (length(p.i) > 0)::int + length(p.x) + length(p.y))), "
            f"case when length(p.i) > 0 then 100 * (1 - (1 + length(p.x))::double / (2 * length(p.i) + 1 + length(p.x))) else 0 end, "
            f"case when length(p.i) > 0 then 100 * (1 - (1 + length(p.y))::double / (2 * length(p.i) + 1 + length(p.y))) else 0 end) end::double)[1]")


def _partial(a: str, b: str) -> str:
    """Best ratio of the shorter text with windows of the longer; texts of equal length both ways."""
    def one(x: str, y: str) -> str:
        window = f"list_slice(mm, greatest(w - length({x}), 0) + 1, least(w, length({y})))"
        score = f"200.0::double * {_common(x, window)} / (length({x}) + least(w, length({y})) - greatest(w - length({x}), 0))"
        return f"list_transform([{_masks(x, y)}], lambda mm: list_max(list_transform(range(1, length({x}) + length({y})), lambda w: {score})))[1]"

    return (f"case when length({a}) = 0 or length({b}) = 0 then case when {a} = {b} then 100.0 else 0.0 end when length({a}) < length({b}) then {one(a, b)} "
            f"when length({a}) > length({b}) then {one(b, a)} else greatest({one(a, b)}, {one(b, a)}) end::double")


_TOKENS = "list_filter(string_split({}, ' '), lambda t: t <> '')"
_SORTED = f"array_to_string(list_sort({_TOKENS}), ' ')"


def _prepared(table: str, *columns: str) -> str:
    """``table`` with the sorted tokens (s_) and the distinct ones (t_) of normalized columns."""
    more = ", ".join(f"{_SORTED.format(c)} as s_{c}, list_distinct({_TOKENS.format(c)}) as t_{c}" for c in columns)
    return f"select *, {more} from {table}"


def _four(a: str, b: str) -> dict[str, str]:
    """The four scores of two normalized columns of a prepared table."""
    return {"ratio": _ratio(a, b), "partial_ratio": _partial(a, b), "token_sort": _ratio(f"s_{a}", f"s_{b}"), "token_set": _set_ratio(f"t_{a}", f"t_{b}")}


def _pair_sql() -> str:
    return _views() + _TRUE + """, c as (select s1_id, candidate_id, n1.name as a, nt.name as b, n1.address as aa, nt.address as ba
  from cand join n1 on s1_id = n1.entity_id join nt on candidate_id = nt.entity_id),
"""


_SCORED = _pair_sql() + f"sc as (select s1_id, candidate_id, {_ratio('a', 'b')} / 100 as match_probability from c)"


# --- Flagship, normalizers, tokens ------------------------------------------------------------------


@query(sql=_views() + f"""p as (select n1.entity_id as s1_id, nt.entity_id as candidate_id from n1 join nt using (country, name) where name <> ''),
{_TRUE}, k as (select source1_entity_id as s1_id, (select count(*) from tp where s1_id = source1_entity_id) as n_true,
  (select count(*) from p where s1_id = source1_entity_id) as n_pred,
  (select count(*) from p join tp using (s1_id, candidate_id) where s1_id = source1_entity_id) as tp from truth)
select round(avg({_f05()}), 9) as macro_f0_5, count(*) as entities from k""")
def flagship_exact_match_f05(v: Views) -> DataFrame:
    found = blocking.exact_name(v.s1, v.targets)
    return evaluate.macro_f05(evaluate.entity_counts(v.raw("truth"), pairs.id_lists(found, v.raw("s1"))))


@query(DOCUMENTS, f"with {_raw(DOCUMENTS)} select entity_id, {_n1('business_name')} as name, {_n1('business_address')} as address from (select * from s1 union all select * from s2 union all select * from s3)")
def normalize_basic(v: Views) -> DataFrame:
    return resolve.normalized(v.all_raw).select("entity_id", "name", "address")


def _blocking_sql(x: str, words: dict[str, str]) -> str:
    plain = f"trim(regexp_replace(regexp_replace(replace(strip_accents(lower({x})), '&', ' and '), '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    cases = " ".join(f"when '{k}' then '{w}'" for k, w in words.items())
    return f"array_to_string(list_transform(string_split({plain}, ' '), lambda t: case t {cases} else t end), ' ')"


@query(sql=f"with {_raw(CUSTOMERS)} select entity_id, {_blocking_sql('business_name', text.NAME_WORDS)} as name, {_blocking_sql('business_address', text.ADDRESS_WORDS)} as address from (select * from s1 union all select * from s2 union all select * from s3)")
def normalize_blocking(v: Views) -> DataFrame:
    return v.all_raw.select("entity_id", text.blocking_name("business_name").alias("name"), text.blocking_address("business_address").alias("address"))


def _unicode(x: str, keep: str, name: bool) -> str:
    folded = f"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '\\s+', ' ', 'g'))"
    folded = f"replace({folded}, '&', ' and ')" if name else folded
    return f"trim(regexp_replace({folded}, '[^\\p{{L}}\\p{{N}}\\p{{M}}{keep}]+', ' ', 'g'))"


@query(DOCUMENTS, f"with {_raw(DOCUMENTS)} select entity_id, {_unicode('business_name', '', True)} as name, strip_accents({_unicode('business_name', '', True)}) as name_ascii from (select * from s1 union all select * from s2 union all select * from s3)")
def normalize_unicode_name(v: Views) -> DataFrame:
    return v.all_raw.select("entity_id", text.unicode_name("business_name").alias("name"), text.unicode_name_ascii("business_name").alias("name_ascii"))


@query(DOCUMENTS, f"with {_raw(DOCUMENTS)} select entity_id, {_unicode('business_address', '-', False)} as address, strip_accents({_unicode('business_address', '-', False)}) as address_ascii from (select * from s1 union all select * from s2 union all select * from s3)")
def normalize_unicode_address(v: Views) -> DataFrame:
    return v.all_raw.select("entity_id", text.unicode_address("business_address").alias("address"), text.unicode_address_ascii("business_address").alias("address_ascii"))


@query(sql=f"""with {_raw(CUSTOMERS)} select entity_id, len(list_filter(string_split_regex(business_address, '\\s+'), lambda t: t <> ''))::int as n_tokens,
len(list_distinct(list_filter(string_split_regex(business_address, '\\s+'), lambda t: t <> '')))::int as n_distinct,
array_to_string(regexp_extract_all(business_address, '\\d+'), ',') as numbers, replace(business_address, ' ', '') as compact
from (select * from s1 union all select * from s2 union all select * from s3)""")
def tokens_numbers(v: Views) -> DataFrame:
    a = "business_address"
    return v.all_raw.select("entity_id", F.size(text.tokens(a)).alias("n_tokens"), F.size(text.token_set(a)).alias("n_distinct"),
                            F.array_join(text.numbers(a), ",").alias("numbers"), text.compact(a).alias("compact"))


@query(sql=_pair_sql() + """j as (select s1_id, candidate_id, string_split(aa, ' ') as x, string_split(ba, ' ') as y, regexp_extract_all(aa, '\\d+') as nx, regexp_extract_all(ba, '\\d+') as ny from c)
select s1_id, candidate_id, round(len(list_intersect(x, y))::double / len(list_distinct(list_concat(x, y))), 9) as jaccard,
case when len(nx) = 0 and len(ny) = 0 then 1.0 when len(nx) = 0 or len(ny) = 0 then 0.0 else round(len(list_intersect(nx, ny))::double / greatest(len(list_distinct(nx)), len(list_distinct(ny))), 9) end::double as numbers from j""")
def token_overlaps(v: Views) -> DataFrame:
    a, b = text.normalize_basic("s1_business_address"), text.normalize_basic("candidate_business_address")
    return v.pair_texts().select("s1_id", "candidate_id", F.round(fuzzy.token_jaccard(text.tokens(a), text.tokens(b)), 9).alias("jaccard"),
                                 F.round(fuzzy.number_overlap(text.numbers(a), text.numbers(b)), 9).alias("numbers"))


# --- Grams and rare anchors -------------------------------------------------------------------------


def _grams(table: str, setup=rare.PRODUCTION) -> str:
    parts = []
    for kind, (column, sizes, _) in setup.items():
        for n in sizes:
            places = f"(select entity_id, country, replace({column}, ' ', '') as x, unnest(range(1, length(replace({column}, ' ', '')) - {n} + 2)) as i from {table})"
            parts.append(f"select distinct entity_id, country, '{kind}' as kind, substr(x, i::int, {n}) as gram from {places}")
    return " union all ".join(parts)


def _rare(of: dict[str, str], setup=rare.PRODUCTION, cap: int = 24, df_of: str = "gt") -> str:
    """Grams, the rarest anchors of every S1 record and the pairs that they hit; frequencies are those of ``df_of``."""
    most = f"case kind when 'n' then {setup['n'][2]} else {setup['a'][2]} end"
    return _views(of) + f"""g1 as materialized ({_grams('n1', setup)}), gt as materialized ({_grams('nt', setup)}), f as (select country, kind, gram, count(*) as df from {df_of} group by all having count(*) <= {cap}),
an as (select g1.entity_id as s1_id, country, kind, gram, df, row_number() over (partition by g1.entity_id, kind order by df, gram) as turn from g1 join f using (country, kind, gram)),
ch as (select *, count(*) over (partition by s1_id, kind) as n_kept from an where turn <= {most}),
hi as (select s1_id, gt.entity_id as candidate_id, count(*) filter (ch.kind = 'n') as name_anchor_hits, count(*) filter (ch.kind = 'a') as address_anchor_hits,
  coalesce(count(*) filter (ch.kind = 'n')::double / max(n_kept) filter (ch.kind = 'n'), 0) as nc, coalesce(count(*) filter (ch.kind = 'a')::double / max(n_kept) filter (ch.kind = 'a'), 0) as ac
  from ch join gt using (country, kind, gram) group by all)"""


_RARE = _rare(DOCUMENTS)


def _reranked(pairs_sql: str) -> str:
    """Scored pairs: best of ratio, partial and token set ratio of either field."""
    def best(a: str, b: str) -> str:
        four = _four(a, b)
        return f"case when {a} = '' or {b} = '' then 0.0 else greatest({four['ratio']}, {four['partial_ratio']}, {four['token_set']}) / 100 end::double"

    texts = "select p.*, n1.name as a, n1.address as aa, nt.name as b, nt.address as ba, nt.source from pr p join n1 on n1.entity_id = s1_id join nt on nt.entity_id = candidate_id"
    return f""", pr as ({pairs_sql}), tx as ({texts}), k as materialized ({_prepared('tx', 'a', 'b', 'aa', 'ba')}),
sc as materialized (select *, {best('a', 'b')} as name_score, {best('aa', 'ba')} as address_score from k)"""


@query(DOCUMENTS, _views(DOCUMENTS) + f"g as ({_grams('nt')}) select entity_id, kind, count(*) as n_grams, min(gram) as first_gram, max(gram) as last_gram from g group by all")
def char_ngrams(v: Views) -> DataFrame:
    return rare.grams(v.targets).groupBy("entity_id", "kind").agg(F.count("*").alias("n_grams"), F.min("gram").alias("first_gram"), F.max("gram").alias("last_gram"))


@query(DOCUMENTS, _views(DOCUMENTS) + f"g as ({_grams('nt')}) select country, kind, gram, count(*) as df from g group by all having count(*) <= 24")
def ngram_document_frequency(v: Views) -> DataFrame:
    return rare.document_frequency(rare.grams(v.targets)).where("df <= 24")


def _crc32(digits: str) -> str:
    """CRC-32 of the bytes whose hexadecimal digits a column holds, bit by bit."""
    shift = "lambda r, k: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end"
    bytes_ = f"list_transform(range(0, length({digits}) // 2), lambda i: ('0x' || substr({digits}, (2 * i + 1)::int, 2))::bigint)"
    return f"xor(list_reduce({bytes_}, lambda c, b: list_reduce(range(8), {shift}, xor(c, b)), 4294967295::bigint), 4294967295)"


@query(sql=_views() + f"""g as materialized ({_grams('nt')}), h as materialized (select country, kind, gram, hex(encode(country || kind || gram)) as x from (select distinct country, kind, gram from g)),
d as materialized (select country, kind, gram, {_crc32('x')} & 16777215 as bucket from h),
e as (select distinct entity_id, country, kind, bucket from g join d using (country, kind, gram)) select country, kind, bucket::varchar as gram, count(*) as df from e group by all""")
def ngram_bucket_crc32(v: Views) -> DataFrame:
    return rare.document_frequency(rare.grams(v.targets, bucket_bits=24))


@query(DOCUMENTS, _RARE + " select s1_id, kind, gram, df, n_kept from ch")
def rare_anchors(v: Views) -> DataFrame:
    index = rare.document_frequency(rare.grams(v.targets))
    return rare.anchors(rare.grams(v.s1), index).select("s1_id", "kind", "gram", "df", "n_kept")


def _hits(v: Views) -> DataFrame:
    return rare.anchor_hits(v.s1, v.targets)


@query(DOCUMENTS, _RARE + " select s1_id, candidate_id, name_anchor_hits, address_anchor_hits, round(nc + ac, 9) as anchor_score from hi")
def rare_anchor_hits(v: Views) -> DataFrame:
    return _hits(v).select("s1_id", "candidate_id", "name_anchor_hits", "address_anchor_hits", F.round("anchor_score", 9).alias("anchor_score"))


@query(DOCUMENTS, _RARE + """, pr as (select s1_id, candidate_id, row_number() over (partition by s1_id, split_part(candidate_id, '-', 1) order by nc + ac desc, candidate_id desc) as turn from hi)
select s1_id, candidate_id from pr where turn <= 80""")
def rare_preselect(v: Views) -> DataFrame:
    return rare.preselect(_hits(v)).select("s1_id", "candidate_id")


@query(DOCUMENTS, _RARE + " select s1_id, candidate_id from hi where name_anchor_hits >= 2 or address_anchor_hits >= 2 or greatest(nc, ac) >= 0.5")
def v31_cheap_filter(v: Views) -> DataFrame:
    return rare.cheap_filter(_hits(v)).select("s1_id", "candidate_id")


_CAP = 512
#: Production overflows at the cap; the part table is too small to reach it.
_OVERFLOW = 10
_KINDS_SQL = {
    "name_address": ("name <> '' and address <> ''", "country, source, name, address", "entity_id", "n1.name = t.name and n1.address = t.address"),
    "name": ("name <> ''", "country, source, name", "address, entity_id", "n1.name = t.name"),
    "address": ("address <> ''", "country, source, address", "name, entity_id", "n1.address = t.address"),
}


def _capped(limit: int) -> str:
    return " union all ".join(
        f"select n1.entity_id as s1_id, '{k}' as kind, t.source, t.entity_id as candidate_id from n1 join (select *, row_number() over (partition by {part} order by {order}) as turn from nt where {filled}) t on n1.country = t.country and {on} where turn <= {limit}"
        for k, (filled, part, order, on) in _KINDS_SQL.items())


_PRODUCTION = _rare(CUSTOMERS) + f""", pl as (select s1_id, candidate_id, row_number() over (partition by s1_id, split_part(candidate_id, '-', 1) order by nc + ac desc, candidate_id desc) as turn from hi), ex as ({_capped(512)})""" + _reranked(
    "select s1_id, candidate_id from pl where turn <= 80 union select s1_id, candidate_id from ex") + """,
bo as (select *, a <> '' and aa <> '' and a = b and aa = ba as both_exact, 0.6::double * name_score + 0.4::double * address_score as score from sc),
ra as (select *, row_number() over (partition by s1_id, source order by both_exact desc, score desc, name_score desc, address_score desc, candidate_id desc) as rank from bo)
select s1_id, candidate_id, source, both_exact, round(name_score, 9) as name_score, round(address_score, 9) as address_score, round(score, 9) as score, rank::int as rank from ra where rank <= 50"""


@query(sql=_PRODUCTION)
def production_candidates(v: Views) -> DataFrame:
    return rare.production_candidates(v.s1, v.targets).withColumns({c: F.round(c, 9) for c in ("name_score", "address_score", "score")})


@query(sql=_rare(CUSTOMERS, rare.SCANNING, 6, "g1") + """, pl as (select *, row_number() over (partition by s1_id, split_part(candidate_id, '-', 1) order by nc + ac desc, candidate_id desc) as turn from hi
  where name_anchor_hits >= 2 or address_anchor_hits >= 2 or greatest(nc, ac) >= 0.5)""" + _reranked("select s1_id, candidate_id, nc, ac from pl where turn <= 80") + """,
bo as (select *, 0.85::double * greatest(name_score, address_score) + 0.15::double * greatest(nc, ac) as score from sc),
ra as (select *, row_number() over (partition by s1_id, source order by score desc, candidate_id desc) as rank from bo),
ms as (select n1.entity_id as s1_id, nt.entity_id as candidate_id, 'exact_name' as m from n1 join nt using (country, name) where name <> '' union all select n1.entity_id, nt.entity_id, 'exact_address' from n1 join nt using (country, address) where address <> ''),
ex as (select s1_id, candidate_id, 1.0::double as score, string_agg(m, '+' order by m) as retrieval_method from ms group by s1_id, candidate_id)
select s1_id, candidate_id, round(score, 9) as score, retrieval_method from (select * from ex union all select s1_id, candidate_id, score, 'rare_anchor' from ra where rank <= 50 and (s1_id, candidate_id) not in (select (s1_id, candidate_id) from ex))""")
def v31_candidates(v: Views) -> DataFrame:
    return rare.scanning_candidates(v.s1, v.targets).withColumn("score", F.round("score", 9))


# --- Exact keys -------------------------------------------------------------------------------------


@query(sql=_views() + "z as (select 1) select n1.entity_id as s1_id, nt.entity_id as candidate_id, 1.0::double as score from n1 join nt using (country, name) where name <> ''")
def exact_name_candidates(v: Views) -> DataFrame:
    return blocking.exact_name(v.s1, v.targets)


@query(PARTS, _views(PARTS) + "z as (select 1) " + _capped(_CAP))
def exact_key_capped(v: Views) -> DataFrame:
    return blocking.exact_capped(v.s1, v.targets, _CAP)


@query(PARTS, _views(PARTS) + "z as (select 1) " + " union all ".join(
    f"select '{k}' as kind, t.source, count(*) as overflow from n1 join (select {part}, count(*) as n from nt where {filled} group by all having count(*) > {_OVERFLOW}) t on n1.country = t.country and {on} group by t.source"
    for k, (filled, part, _, on) in _KINDS_SQL.items()))
def exact_key_overflow(v: Views) -> DataFrame:
    return blocking.exact_overflow(v.s1, v.targets, _OVERFLOW)


@query(PARTS, _views(PARTS) + """m as (select n1.entity_id as s1_id, nt.entity_id as candidate_id, 'exact_name' as m from n1 join nt using (country, name) where name <> ''
union all select n1.entity_id, nt.entity_id, 'exact_address' from n1 join nt using (country, address) where address <> '')
select s1_id, candidate_id, string_agg(m, '+' order by m) as retrieval_method from m group by all""")
def exact_methods_merged(v: Views) -> DataFrame:
    return blocking.exact_methods(v.s1, v.targets)


# --- TF-IDF -----------------------------------------------------------------------------------------

_UNIT = _views() + """no_ as (select 1), al as (select country, source, 't' as side, entity_id, name, address from nt
  union all select n1.country, s.source, 's1', entity_id, name, address from n1 join (select distinct country, source from nt) s using (country)),
co as (select country, source, side, entity_id, f.field, f.text from (select *, unnest({fields}) as f from al)),
nd as (select country, source, field, count(*) as n from co group by all),
wd as (select country, source, field, side, entity_id, ' ' || unnest(list_filter(string_split(lower(text), ' '), lambda t: t <> '')) || ' ' as w from co),
gr as (select country, source, field, side, entity_id, unnest(flatten(list_transform([2, 3, 4], lambda n: case when n = 2 or length(w) >= n then list_transform(range(1, length(w) - n + 2), lambda i: substr(w, i::int, n::int)) else [] end))) as gram from wd),
tf as (select *, count(*) as tf from gr group by all),
idf as (select country, source, field, gram, count(*) as df, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 as idf from tf join nd using (country, source, field) group by country, source, field, gram having count(*) >= 2),
wt as (select tf.*, tf * idf as w from tf join idf using (country, source, field, gram)),
no as (select country, source, field, side, entity_id, sqrt(sum(w * w)) as norm from wt group by all),
un as materialized (select country, source, field, side, entity_id, gram, w / norm as w from wt join no using (country, source, field, side, entity_id)),
si as (select country, source, field, a.entity_id as s1_id, b.entity_id as candidate_id, sum(a.w * b.w) as score from un a join un b using (country, source, field, gram) where a.side = 's1' and b.side = 't' group by all),
ra as (select *, row_number() over (partition by country, source, field, s1_id order by round(score, 12) desc, candidate_id) as turn from si where score >= 0.25)
"""
_FIELD = "{{'field': '{0}', 'text': {1}}}"
_TFIDF = _UNIT.replace("{fields}", f"[{_FIELD.format('name', 'name')}]") + "select s1_id, candidate_id, round(score, 9) as score from ra where turn <= 30"
_RANKED = _UNIT.replace("{fields}", "[" + ", ".join(_FIELD.format(f, t) for f, t in (("name", "name"), ("address", "address"), ("combined", "trim(name || ' ' || address)"))) + "]") + """,
ev as (select s1_id, candidate_id, score from ra where turn <= 20 union all select n1.entity_id, nt.entity_id, 1.0 from n1 join nt using (country, name) where name <> ''),
mx as (select s1_id, candidate_id, max(score) as score from ev group by all)
select s1_id as source1_entity_id, candidate_id as candidate_entity_id, split_part(candidate_id, '-', 1) as candidate_source, round(score, 9) as retrieval_score,
row_number() over (partition by s1_id order by round(score, 12) desc, candidate_id)::int as retrieval_rank from mx"""


@query(sql=_TFIDF)
def tfidf_name_topn(v: Views) -> DataFrame:
    found = tfidf.neighbours(v.s1, v.targets, ("name",))
    return found.select("s1_id", "candidate_id", F.round("score", 9).alias("score"))


@query(sql=_RANKED)
def tfidf_candidates_ranked(v: Views) -> DataFrame:
    return tfidf.candidates(v.s1, v.targets).withColumn("retrieval_score", F.round("retrieval_score", 9))


@query(sql=_views() + """sc as (select n1.entity_id as s1_id, nt.entity_id as candidate_id, 1.0 as score from n1 join nt using (country, name) where name <> '')
select entity_id as source1_entity_id, coalesce((select string_agg(candidate_id, ',' order by candidate_id) from sc where s1_id = entity_id), '') as candidate_entity_ids from n1""")
def candidates_submission_shape(v: Views) -> DataFrame:
    return pairs.submission(tfidf.ranked(blocking.exact_name(v.s1, v.targets)), v.raw("s1"), 30)


# --- Similarities and features ----------------------------------------------------------------------

@query(sql=_pair_sql() + f"z as (select 1) select s1_id, candidate_id, {_ratio('a', 'b')} as score from c")
def fuzzy_ratio(v: Views) -> DataFrame:
    a, b = text.normalize_basic("s1_business_name"), text.normalize_basic("candidate_business_name")
    return v.pair_texts().select("s1_id", "candidate_id", fuzzy.ratio(a, b).alias("score"))


@query(sql=_pair_sql() + f"d as materialized (select s1_id, candidate_id, {_SORTED.format('a')} as a, {_SORTED.format('b')} as b from c) select s1_id, candidate_id, {_ratio('a', 'b')} as score from d")
def fuzzy_token_sort(v: Views) -> DataFrame:
    a, b = text.normalize_basic("s1_business_name"), text.normalize_basic("candidate_business_name")
    return v.pair_texts().select("s1_id", "candidate_id", fuzzy.token_sort_ratio(a, b).alias("score"))


def _distinct_tokens(c: str) -> str:
    return f"list_distinct({_TOKENS.format(c)})"


@query(sql=_pair_sql() + f"""t as materialized (select s1_id, candidate_id, {_distinct_tokens('a')} as ta, {_distinct_tokens('b')} as tb from c)
select s1_id, candidate_id, round({_set_ratio('ta', 'tb')}, 9)::double as score from t""")
def fuzzy_token_set(v: Views) -> DataFrame:
    a, b = text.normalize_basic("s1_business_name"), text.normalize_basic("candidate_business_name")
    return v.pair_texts().select("s1_id", "candidate_id", F.round(fuzzy.token_set_ratio(a, b), 9).alias("score"))


@query(sql=_pair_sql() + f"z as (select 1) select s1_id, candidate_id, {_partial('a', 'b')} as score from c")
def fuzzy_partial(v: Views) -> DataFrame:
    a, b = text.normalize_basic("s1_business_name"), text.normalize_basic("candidate_business_name")
    return v.pair_texts().select("s1_id", "candidate_id", fuzzy.partial_ratio(a, b).alias("score"))


def _features_sql() -> str:
    raw, scores, out = [], [], []
    for part, a, b in (("name", "a", "b"), ("address", "aa", "ba")):
        raw += [f"{score} as {part}_{label}" for label, score in _four(a, b).items()]
        scores += [f"(case when {a} = '' or {b} = '' then 0.0 else {part}_{label} / 100 end)::double as {part}_{label}" for label in fuzzy.SCORES]
        scores += [f"({a} <> '' and {a} = {b})::int::double as {part}_exact",
                   f"(case when {a} = '' or {b} = '' then 0 else least(length({a}), length({b}))::double / greatest(length({a}), length({b})) end)::double as {part}_length_ratio",
                   f"(case when {a} = '' or {b} = '' then 0.0 else greatest({', '.join(f'{part}_{label}' for label in fuzzy.SCORES)}) / 100 end)::double as max_{part}_similarity"]
    whole = _pair_sql() + f"""k as materialized ({_prepared('c', 'a', 'b', 'aa', 'ba')}), r as materialized (select k.*, {', '.join(raw)} from k), x as (select s1_id, candidate_id, {', '.join(scores)} from r)
"""
    out = [f"{f}::float as {f}" for f in FEATURES_16 if f not in ("same_country", "combined_similarity")]
    return whole + f"""select s1.business_name as s1_business_name, s1.business_address as s1_business_address, s1.country as s1_country, o.business_name as candidate_business_name,
o.business_address as candidate_business_address, o.country as candidate_country, s1_id, candidate_id, {', '.join(out)}, (s1.country = o.country)::int::float as same_country,
(0.6::double * max_name_similarity + 0.4::double * max_address_similarity)::float as combined_similarity
from x join s1 on s1.entity_id = s1_id join (select * from s2 union all select * from s3) o on o.entity_id = candidate_id"""


@query(sql=_features_sql())
def features_16_matrix(v: Views) -> DataFrame:
    return features_16(v.pair_texts())


@query(sql=_pair_sql() + """z as (select 1) select s1_id, candidate_id, (a <> '' and a = b)::int::float as name_exact,
(case when a = '' or b = '' then 0 else least(length(a), length(b))::double / greatest(length(a), length(b)) end)::float as name_length_ratio,
(aa <> '' and aa = ba)::int::float as address_exact, (case when aa = '' or ba = '' then 0 else least(length(aa), length(ba))::double / greatest(length(aa), length(ba)) end)::float as address_length_ratio,
(select s.country = t.country from s1 s, (select * from s2 union all select * from s3) t where s.entity_id = s1_id and t.entity_id = candidate_id)::int::float as same_country from c""")
def features_16_exact(v: Views) -> DataFrame:
    return features_16(v.pair_texts()).select("s1_id", "candidate_id", "name_exact", "name_length_ratio", "address_exact", "address_length_ratio", "same_country")


def _features_26_sql() -> str:
    def row(part: str, a: str, b: str) -> str:
        four = _four(a, b)
        named = {f"{part}1_missing": f"({a} = '')::int", f"{part}2_missing": f"({b} = '')::int", f"{part}_exact": f"({a} = {b})::int",
                 f"{part}_ascii_exact": f"(strip_accents({a}) = strip_accents({b}))::int", f"{part}_ratio": f"{four['ratio']} / 100", f"{part}_partial_ratio": f"{four['partial_ratio']} / 100",
                 f"{part}_token_sort_ratio": f"{four['token_sort']} / 100", f"{part}_token_set_ratio": f"round({four['token_set']} / 100, 9)"}
        x, y = f"t_{a}", f"t_{b}"
        share = lambda p, q, below: f"case when len({p}) = 0 and len({q}) = 0 then 1.0 when len({p}) = 0 or len({q}) = 0 then 0.0 else len(list_intersect({p}, {q}))::double / {below} end::double"
        named[f"{part}_token_jaccard"] = share(x, y, f"len(list_distinct(list_concat({x}, {y})))")
        if part == "address":
            p, q = (f"list_distinct(regexp_extract_all({c}, '\\d+'))" for c in (a, b))
            named["address_number_overlap"] = share(p, q, f"greatest(len({p}), len({q}))")
        named[f"{part}_length_ratio"] = f"case when {a} = '' and {b} = '' then 1.0 when {a} = '' or {b} = '' then 0.0 else least(length({a}), length({b}))::double / greatest(length({a}), length({b})) end::double"
        return ", ".join(f"{e} as {n}" for n, e in named.items())

    texts = ", ".join(f"{_unicode(f'coalesce({t}.business_{c}, {chr(39) * 2})', '' if c == 'name' else '-', c == 'name')} as {p}{c[0]}" for p, t in (("x", "s1"), ("y", "o")) for c in ("name", "address"))
    return f"""with {_raw(CUSTOMERS)}, o as (select * from s2 union all select * from s3),
c as (select s1_id, candidate_id, s1.business_name as s1_business_name, s1.business_address as s1_business_address, s1.country as s1_country, o.business_name as candidate_business_name,
  o.business_address as candidate_business_address, o.country as candidate_country, {texts} from cand join s1 on s1_id = s1.entity_id join o on candidate_id = o.entity_id),
k as materialized ({_prepared('c', 'xn', 'xa', 'yn', 'ya')})
select * exclude (xn, xa, yn, ya, s_xn, s_xa, s_yn, s_ya, t_xn, t_xa, t_yn, t_ya), {row('name', 'xn', 'yn')}, {row('address', 'xa', 'ya')}, (s1_country <> '' and lower(s1_country) = lower(candidate_country))::int as same_country, split_part(candidate_id, '-', 1) as candidate_source,
(candidate_id like 'S2-%')::int as candidate_is_s2, (candidate_id like 'S3-%')::int as candidate_is_s3, 0.5::double as retrieval_score, 1.0::double as retrieval_rank from k"""


@query(sql=_features_26_sql())
def features_26_extended(v: Views) -> DataFrame:
    both = v.pair_texts().withColumns({"candidate_source": text.id_source("candidate_id"), "retrieval_score": F.lit("0.5"), "retrieval_rank": F.lit(1)})
    return features_26(both).withColumns({c: F.round(c, 9) for c in ("name_token_set_ratio", "address_token_set_ratio")})


# --- Labels and metrics -----------------------------------------------------------------------------

_LISTS = _views() + _TRUE + """, cd as (select distinct s1_id, candidate_id from cand),
fo as (select tp.*, cd.s1_id is not null as found from tp left join cd using (s1_id, candidate_id))
"""


@query(sql=_LISTS + "select cand.s1_id, cand.candidate_id, (tp.s1_id is not null)::int as label from cand left join tp on cand.s1_id = tp.s1_id and cand.candidate_id = tp.candidate_id")
def label_pairs(v: Views) -> DataFrame:
    return pairs.label(v.raw("cand"), v.raw("truth"))


@query(sql=_LISTS + "select count(*) as total_pairs, count(tp.s1_id) as positive_pairs, count(*) - count(tp.s1_id) as negative_pairs, count(tp.s1_id)::double / count(*) as positive_rate from cand left join tp on cand.s1_id = tp.s1_id and cand.candidate_id = tp.candidate_id")
def label_stats(v: Views) -> DataFrame:
    return pairs.label_stats(pairs.label(v.raw("cand"), v.raw("truth")))


@query(sql=_LISTS + "select avg(found::int) as recall, count(*) as true_pairs, count(*) filter (found) as found_pairs, count(*) filter (not found) as missed_pairs from fo")
def blocking_recall(v: Views) -> DataFrame:
    return evaluate.blocking_recall(v.raw("truth"), v.raw("cand"))


@query(sql=_LISTS + "select split_part(candidate_id, '-', 1) as source, avg(found::int) as recall, count(*) as true_pairs from fo group by 1")
def recall_by_source(v: Views) -> DataFrame:
    return evaluate.recall_by_source(v.raw("truth"), v.raw("cand"))


@query(sql=_LISTS + ", n as (select entity_id, (select count(*) from cd where s1_id = entity_id) as n from s1) select avg(n) as mean, median(n) as median, max(n) as max, count(*) filter (n = 0) as zero from n")
def candidate_density(v: Views) -> DataFrame:
    return evaluate.candidate_density(v.raw("s1"), v.raw("cand"))


@query(sql=_LISTS + ", e as (select s1_id, count(*) filter (found) as tp, count(*) as n from fo group by 1) select sum(tp)::double / sum(n) as link_recall, avg((tp > 0)::int) as any_recall, avg((tp = n)::int) as complete_recall, count(*) as entities from e")
def entity_recall(v: Views) -> DataFrame:
    return evaluate.entity_recall(v.raw("truth"), v.raw("cand"))


@query(sql=_LISTS + f", e as (select source1_entity_id, (select count(*) from fo where s1_id = source1_entity_id and found) as tp, (select count(*) from fo where s1_id = source1_entity_id) as n_true from truth) select round(avg({_f05('tp', 'tp', 'n_true')}), 9) as macro_f0_5, count(*) as entities from e")
def oracle_ceiling(v: Views) -> DataFrame:
    return evaluate.oracle_ceiling(v.raw("truth"), v.raw("cand"))


@query(sql=_LISTS + "select s1_id, candidate_id from fo where not found")
def missed_pairs(v: Views) -> DataFrame:
    return evaluate.missed_pairs(v.raw("truth"), v.raw("cand"))


def _diagnostics_sql() -> str:
    scores = []
    for part, a, b in (("name", "a", "b"), ("address", "aa", "ba")):
        scores += [f"case when {a} = '' or {b} = '' then 0.0 else {score} / 100 end::double as {part}_{label}" for label, score in _four(a, b).items() if (part, label) != ("address", "token_sort")]
    best = {p: ", ".join(f"{p}_{x}" for x in fuzzy.SCORES if (p, x) != ("address", "token_sort")) for p in ("name", "address")}
    return (_pair_sql().replace("from cand join n1", "from (select s1_id, candidate_id from tp except select s1_id, candidate_id from cand) join n1") + f"""k as materialized ({_prepared('c', 'a', 'b', 'aa', 'ba')}),
m as materialized (select s1_id, candidate_id, {', '.join(scores)} from k)
select s1_id, candidate_id, """ + ", ".join(f"round({c}, 9) as {c}" for p in best for c in best[p].split(", ")) + "".join(f", round(greatest({best[p]}), 9) as max_{p}" for p in best) + " from m")


@query(sql=_diagnostics_sql())
def missed_pair_diagnostics(v: Views) -> DataFrame:
    out = missed_diagnostics(v.pair_texts(evaluate.missed_pairs(v.raw("truth"), v.raw("cand"))))
    return out.select("s1_id", "candidate_id", *(F.round(c, 9).alias(c) for c in out.columns[2:]))


@query(sql=_SCORED + """, q as (select quantile_cont(match_probability, [0.10, 0.25, 0.50, 0.75, 0.90, 0.95]) as v from sc)
select 'match_probability' as feature, unnest([0.10, 0.25, 0.50, 0.75, 0.90, 0.95])::double as quantile, round(unnest(v), 9) as value from q""")
def missed_similarity_quantiles(v: Views) -> DataFrame:
    return evaluate.quantiles(v.scored(), "match_probability").withColumn("value", F.round("value", 9))


@query(sql=_pair_sql() + f"""s as (select {_ratio('a', 'b')} / 100 as x, {_ratio('aa', 'ba')} / 100 as y from c),
t as (select unnest([50, 60, 70, 80, 90]) as percent)
select percent, round(avg((x >= percent / 100.0::double)::int), 9) as name_coverage, round(avg((y >= percent / 100.0::double)::int), 9) as address_coverage, round(avg((x >= percent / 100.0::double or y >= percent / 100.0::double)::int), 9) as either_coverage from s, t group by percent""")
def threshold_coverage(v: Views) -> DataFrame:
    norm = {p + c: text.normalize_basic(f"{p}_business_{c}") for p in ("s1", "candidate") for c in ("name", "address")}
    both = v.pair_texts().select(*(e.alias(k) for k, e in norm.items()))
    both = both.select((fuzzy.ratio(F.col("s1name"), F.col("candidatename")) / 100).alias("x"), (fuzzy.ratio(F.col("s1address"), F.col("candidateaddress")) / 100).alias("y"))
    out = evaluate.threshold_coverage(both, "x", "y", [50, 60, 70, 80, 90])
    return out.select("percent", *(F.round(c, 9).alias(c) for c in ("name_coverage", "address_coverage", "either_coverage")))


def _entity_sql(percent: str) -> str:
    return _SCORED + f""", pr as (select s1_id, candidate_id from sc where match_probability >= {percent} / 100.0::double),
k as (select source1_entity_id, (select count(*) from pr join tp using (s1_id, candidate_id) where s1_id = source1_entity_id) as tp,
  (select count(*) from pr where s1_id = source1_entity_id) as n_pred, (select count(*) from tp where s1_id = source1_entity_id) as n_true from truth)
"""


def _predicted(v: Views) -> DataFrame:
    return pairs.select_matches(v.scored(), v.raw("s1"), 0.8)


@query(sql=_entity_sql("80") + f"select source1_entity_id, tp, n_pred, n_true, round({_f05()}, 9) as f0_5 from k")
def entity_f05(v: Views) -> DataFrame:
    out = evaluate.entity_f05(evaluate.entity_counts(v.raw("truth"), _predicted(v)))
    return out.select("source1_entity_id", *(F.col(c).cast("long").alias(c) for c in ("tp", "n_pred", "n_true")), F.round("f0_5", 9).alias("f0_5"))


@query(sql=_entity_sql("80") + "select sum(tp)::double / sum(n_pred) as precision, sum(tp)::double / sum(n_true) as recall, sum(tp)::bigint as true_positives from k")
def micro_precision_recall(v: Views) -> DataFrame:
    return evaluate.micro(evaluate.entity_counts(v.raw("truth"), _predicted(v)))


@query(sql=_entity_sql("80") + "select entity_id as source1_entity_id, coalesce((select string_agg(candidate_id, ',' order by candidate_id) from (select distinct * from pr) where s1_id = entity_id), '') as matched_entity_ids from s1")
def threshold_predictions(v: Views) -> DataFrame:
    return _predicted(v)


_SWEEP = _SCORED + f""", g as (select unnest(range(5, 100, 5))::int as percent),
pc as (select percent, p.s1_id, count(*) as n_pred, count(tp.s1_id) as tp from (select percent, s1_id, candidate_id from g, sc where match_probability >= percent / 100.0::double) p left join tp on p.s1_id = tp.s1_id and p.candidate_id = tp.candidate_id group by percent, p.s1_id),
ny as (select s1_id, count(*) as n_true from tp group by 1),
e as (select g.percent, coalesce(pc.tp, 0) as tp, coalesce(n_pred, 0) as n_pred, coalesce(n_true, 0) as n_true from g cross join truth t left join pc on pc.percent = g.percent and pc.s1_id = source1_entity_id left join ny on ny.s1_id = source1_entity_id),
sw as (select percent, round(avg({_f05()}), 9) as macro_f0_5 from e group by percent)
"""


def _sweep(v: Views) -> DataFrame:
    return evaluate.threshold_sweep(v.scored(), v.raw("truth"), list(range(5, 100, 5)))


@query(sql=_SWEEP + "select * from sw")
def threshold_sweep(v: Views) -> DataFrame:
    return _sweep(v)


@query(sql=_SWEEP + "select percent, macro_f0_5 from sw order by macro_f0_5 desc, percent desc limit 1")
def best_threshold(v: Views) -> DataFrame:
    return evaluate.best_threshold(_sweep(v))


# --- Models -----------------------------------------------------------------------------------------


def _labelled(v: Views) -> DataFrame:
    """Cheap features of labelled pairs, for the classifier queries."""
    return pairs.label(features_16(v.pair_texts()), v.raw("truth"))


def _fitted(v: Views):
    split = model.entity_split(v.raw("s1")).select(F.col("entity_id").alias("s1_id"), "split")
    marked = _labelled(v).join(split, "s1_id")
    fitted = model.train(marked.where("split = 'train'").drop("split"), list(model.FEATURES_16), model.build_classifier(10, 4, 0.2))
    return fitted, marked.where("split = 'validation'").drop("split")


@query(sql=f"""with {_raw(CUSTOMERS)}, r as (select entity_id, country, row_number() over (partition by country order by md5('42-' || entity_id), entity_id) as turn, count(*) over (partition by country) as n from s1)
select entity_id, country, case when turn <= ceil(n * 20 / 100.0) then 'validation' else 'train' end as split from r""")
def entity_split(v: Views) -> DataFrame:
    return model.entity_split(v.raw("s1"))


@query(sql=f"with {_raw(CUSTOMERS)} select * from s1 order by md5('42-' || entity_id), entity_id limit 100")
def entity_sample(v: Views) -> DataFrame:
    return model.entity_sample(v.raw("s1"), 100)


@query()
def gbt_scores(v: Views) -> DataFrame:
    fitted, held = _fitted(v)
    return model.score(fitted, held).select("s1_id", "candidate_id", "label", "match_probability")


@query()
def gbt_importance(v: Views) -> DataFrame:
    return model.importance(_fitted(v)[0], v.spark)


@query()
def gbt_matches(v: Views) -> DataFrame:
    fitted, held = _fitted(v)
    ids = held.select(F.col("s1_id").alias("entity_id")).distinct()
    return pairs.select_matches(model.score(fitted, held), ids, 0.56)


# --- Validation -------------------------------------------------------------------------------------

_BAD = """, matching as (select * from truth where source1_entity_id <> 'S1-7' union all select 'S1-8', 'S2-8' union all select 'X1-5', 'S2-4'
  union all select '', '' union all select 'S1-99999999', 'S2-10,S2-10,S3-3,S1-4,Q9,S2-99999999'),
candidates as (select source1_entity_id, matched_entity_ids as candidate_entity_ids from truth where source1_entity_id <> 'S1-9'
  union all select 'S1-99999999', 'S2-10')"""


def _faulty(v: Views) -> tuple[DataFrame, DataFrame]:
    truth = v.raw("truth")
    more = lambda rows, c: v.spark.createDataFrame(rows, f"source1_entity_id string, {c} string")
    matching = truth.where("source1_entity_id <> 'S1-7'").unionByName(more(
        [("S1-8", "S2-8"), ("X1-5", "S2-4"), ("", ""), ("S1-99999999", "S2-10,S2-10,S3-3,S1-4,Q9,S2-99999999")], "matched_entity_ids"))
    candidates = truth.withColumnRenamed("matched_entity_ids", "candidate_entity_ids").where("source1_entity_id <> 'S1-9'")
    return matching, candidates.unionByName(more([("S1-99999999", "S2-10")], "candidate_entity_ids"))


def _table_sql(table: str, column: str, file: str) -> str:
    lists = f"(select source1_entity_id as s1_id, unnest(case when {column} = '' then [] else string_split({column}, ',') end) as id from {table})"
    return f"""select '{file}' as file, 'empty_s1' as code, source1_entity_id as s1_id, null::varchar as detail from {table} where source1_entity_id = ''
union all select '{file}', 'bad_s1_prefix', source1_entity_id, null from {table} where source1_entity_id <> '' and not starts_with(source1_entity_id, 'S1-')
union all select '{file}', 'duplicate_s1', source1_entity_id, count(*)::varchar from {table} group by source1_entity_id having count(*) > 1
union all select '{file}', 'duplicate_listed_id', s1_id, id from {lists} group by s1_id, id having count(*) > 1
union all select distinct '{file}', 'self_match', s1_id, id from {lists} where starts_with(id, 'S1-')
union all select distinct '{file}', 'bad_listed_prefix', s1_id, id from {lists} where not regexp_matches(id, '^S[123]-.+$')
union all select '{file}', 'missing_s1', entity_id, null from s1 where entity_id not in (select source1_entity_id from {table})
union all select distinct '{file}', 'extra_s1', source1_entity_id, null from {table} where source1_entity_id not in (select entity_id from s1)
union all select distinct '{file}', 'unknown_target', s1_id, id from {lists} where regexp_matches(id, '^S[23]-.+$') and id not in (select entity_id from s2 union all select entity_id from s3)"""


_FOUND = f"""with {_raw(CUSTOMERS)}{_BAD}, viol as ({_table_sql('matching', 'matched_entity_ids', 'matching')} union all {_table_sql('candidates', 'candidate_entity_ids', 'candidates')}
union all select distinct 'matching', 'match_not_candidate', m.s1_id, m.id from (select source1_entity_id as s1_id, unnest(string_split(matched_entity_ids, ',')) as id from matching where matched_entity_ids <> '') m
left join (select source1_entity_id as s1_id, unnest(string_split(candidate_entity_ids, ',')) as id from candidates where candidate_entity_ids <> '') c on m.s1_id = c.s1_id and m.id = c.id where c.id is null)
"""


@query(sql=_FOUND + "select * from viol")
def qa_violations(v: Views) -> DataFrame:
    return qa.violations(*_faulty(v), v.raw("s1"), v.raw("s2").unionByName(v.raw("s3")))


@query(sql=_FOUND + """select case when code = 'match_not_candidate' then 'warning' else 'error' end as severity, file, code, count(*) as n,
array_to_string(list_slice(list_sort(list_distinct(list(coalesce(detail, s1_id)))), 1, 5), ', ') as examples from viol group by file, code""")
def qa_official_rules(v: Views) -> DataFrame:
    return qa.official(*_faulty(v), v.raw("s1"), v.raw("s2").unionByName(v.raw("s3")))


@query(sql=f"""with {_raw(CUSTOMERS)}{_BAD} select distinct x as entity_id from (select unnest(string_split(candidate_entity_ids, ',')) as x from (select candidate_entity_ids from candidates union all select 'S2-99999999') where candidate_entity_ids <> '')
where x not in (select entity_id from s2 union all select entity_id from s3)""")
def qa_target_existence(v: Views) -> DataFrame:
    candidates = _faulty(v)[1].unionByName(v.spark.createDataFrame([("S1-1", "S2-99999999")], "source1_entity_id string, candidate_entity_ids string"))
    return qa.unknown_targets(candidates, v.raw("s2").unionByName(v.raw("s3")))


def _positions(df: DataFrame, column: str) -> DataFrame:
    """Position by number in the id; the views have no file order."""
    return df.withColumn("row_idx", F.split_part(F.col(column), F.lit("-"), F.lit(2)).cast("long"))


@query(sql=f"""with {_raw(CUSTOMERS)}, t as (select split_part(source1_entity_id, '-', 2)::bigint as row_idx, case when source1_entity_id = 'S1-3' then 'S1-4' else source1_entity_id end as id from truth where source1_entity_id <> 'S1-7')
select coalesce(split_part(entity_id, '-', 2)::bigint, row_idx) as row_idx, entity_id as s1_id, id as match_id, source1_entity_id as candidate_row_id
from s1 full outer join t on split_part(entity_id, '-', 2)::bigint = row_idx left join truth on source1_entity_id = entity_id
where entity_id is distinct from id""")
def qa_lockstep(v: Views) -> DataFrame:
    truth = _positions(v.raw("truth"), "source1_entity_id")
    moved = truth.where("source1_entity_id <> 'S1-7'").withColumn("source1_entity_id", F.when(F.col("source1_entity_id") == "S1-3", "S1-4").otherwise(F.col("source1_entity_id")))
    return qa.lockstep(_positions(v.raw("s1"), "entity_id"), moved, truth)


@query(sql=_FOUND + "select count(*) as source1_rows, sum(c)::bigint as candidate_pairs, sum(m)::bigint as predicted_links, count(*) filter (m = 0) as zero_matches, count(*) filter (c = 0) as zero_candidates, avg(c) as average_candidates from (select case when matched_entity_ids = '' then 0 else len(list_distinct(string_split(matched_entity_ids, ','))) end as m, case when candidate_entity_ids = '' then 0 else len(list_distinct(string_split(candidate_entity_ids, ','))) end as c from truth join candidates using (source1_entity_id))")
def run_totals(v: Views) -> DataFrame:
    return qa.run_totals(v.raw("truth"), _faulty(v)[1])


@query(sql=f"with {_raw(CUSTOMERS)}{_BAD} select entity_id as id, 'missing' as side from s1 where entity_id not in (select source1_entity_id from matching) union all select distinct source1_entity_id, 'extra' from matching where source1_entity_id not in (select entity_id from s1)")
def coverage_antijoins(v: Views) -> DataFrame:
    return pairs.missing_and_extra(v.raw("s1").withColumnRenamed("entity_id", "source1_entity_id"), _faulty(v)[0], "source1_entity_id")


@query(PARTS, f"with {_raw(PARTS)} select business_name, count(*) as n from (select * from s1 union all select * from s2 union all select * from s3) group by 1 having count(*) > 1")
def duplicate_ids(v: Views) -> DataFrame:
    return pairs.repeated(v.all_raw, "business_name")


@query(sql=_LISTS + """, x as (select s1_id, list_sort(list(candidate_id)) as c from cd group by 1), y as (select s1_id, list_sort(list(candidate_id)) as t from tp group by 1)
select s1_id, array_to_string(list_sort(list_intersect(c, t)), ',') as both_sides, array_to_string(list_sort(list_filter(c, lambda z: not list_contains(t, z))), ',') as only_candidates, list_has_all(c, t) as complete from x join y using (s1_id)""")
def id_set_operations(v: Views) -> DataFrame:
    c = v.raw("cand").groupBy("s1_id").agg(F.collect_set("candidate_id").alias("c"))
    t = v.raw("truth").select(F.col("source1_entity_id").alias("s1_id"), text.id_list("matched_entity_ids").alias("t")).where("size(t) > 0")
    joined = lambda x: F.array_join(F.sort_array(x), ",")
    return c.join(t, "s1_id").select("s1_id", joined(F.array_intersect("c", "t")).alias("both_sides"), joined(F.array_except("c", "t")).alias("only_candidates"), (F.size(F.array_except("t", "c")) == 0).alias("complete"))


# --- Reports ----------------------------------------------------------------------------------------


@query(sql=f"with {_raw(CUSTOMERS)} " + " union all ".join(
    f"select '{t}' as \"table\", '{c}' as \"column\", count(*) as rows, count(*) filter ({c} is null or {c} = '') as missing from {t}" for t in ("s1", "s2", "s3") for c in tables.RECORD.names))
def profile_sources(v: Views) -> DataFrame:
    return reports.profile(v.raw("s1"), "s1").unionByName(reports.profile(v.raw("s2"), "s2")).unionByName(reports.profile(v.raw("s3"), "s3"))


@query(sql=f"with {_raw(CUSTOMERS)} select country, count(*) as records from s1 group by 1")
def country_distribution(v: Views) -> DataFrame:
    return reports.country_counts(v.raw("s1"))


_TRACKED = [("e1", "2026-01-01", "1", "a.tsv", "PASS"), ("e2", "2026-01-01", "2", "b.tsv", "PASS"), ("e3", "2026-01-01", "", "", "PASS"), ("e4", "2026-01-02", "1", "c.tsv", "PASS")]


@query(sql="select date, count(*) as submissions from (values " + ", ".join(str(r) for r in _TRACKED) + ") t(experiment_id, date, submission_number_for_day, submission_file, validator_status) where submission_number_for_day <> '' or submission_file <> '' group by 1")
def tracker_daily_counts(v: Views) -> DataFrame:
    rows = v.spark.createDataFrame(_TRACKED, "experiment_id string, date string, submission_number_for_day string, submission_file string, validator_status string")
    return reports.daily_submissions(rows)


_MARKED = " || ".join(f"case when {c} is null then 'n;' else 'v' || length({c}) || ':' || {c} end" for c in tables.RECORD.names)


@query(sql=f"""with {_raw(CUSTOMERS)}, h as (select md5({_MARKED}) as h from (select * from s1 union all select * from s2 union all select * from s3))
select count(*) as rows, bit_xor(('0x' || substr(h, 1, 15))::bigint) as xor_hash, sum(('0x' || substr(h, 17, 15))::bigint)::varchar as sum_hash from h""")
def content_fingerprint(v: Views) -> DataFrame:
    return tables.fingerprint(v.all_raw)


@query(sql=f"with {_raw(CUSTOMERS)} select * from s1 where entity_id in (select 'S1-' || (row_number() over () * 10)::varchar from range(20))")
def find_records(v: Views) -> DataFrame:
    return tables.find_records(v.raw("s1"), v.spark.range(1, 21).select(F.concat(F.lit("S1-"), F.col("id") * 10).alias("entity_id")))


@query(sql=_views() + f"""{_TRUE}, p as (select n1.entity_id as s1_id, nt.entity_id as candidate_id from n1 join nt using (country, name) where name <> ''
union select s1_id, candidate_id from cand)
select s1_id, candidate_id, row_number() over (partition by s1_id order by candidate_id) as turn from p""")
def union_and_rank(v: Views) -> DataFrame:
    both = blocking.exact_name(v.s1, v.targets).select("s1_id", "candidate_id").union(v.raw("cand")).distinct()
    return both.withColumn("turn", F.row_number().over(Window.partitionBy("s1_id").orderBy("candidate_id")))
