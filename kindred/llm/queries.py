"""The operators as queries over the whole tables, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import ann, bpe, html_text, language_id, lattice_dedup, line_dedup, mixing, odd_minhash, unit_dedup, url_filter
from kindred.llm.common import read_table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def tokenizer() -> tuple[str, str]:
    """(path, pattern) of the public vocabulary in production use."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.repeated_spans(read_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages, fetched on a day that their id names; the list is made from their own hosts."""
    pages = read_table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.timestamp_add("DAY", F.pmod("page_id", F.lit(730)).cast("int"), F.lit("2023-01-01").cast("timestamp")).alias("fetched_at"))
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    day = lambda n: F.timestamp_add("DAY", n, F.lit("2023-01-01").cast("timestamp"))  # noqa: E731
    n = F.char_length("host")
    dated = [
        ("host", F.col("host"), "block", n % 3 == 0, n * 37 % 400),
        ("host", F.col("host"), "clear", n % 3 == 0, n * 37 % 400 + 200),
        ("prefix", F.concat("host", F.lit("/en")), "block", n % 2 == 0, n * 11 % 300),
        ("prefix", F.concat("host", F.lit("/en")), "allow", n % 2 == 0, n * 11 % 300 + 250),
        ("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "block", n % 5 == 0, n * 7 % 500 + 100),
        ("domain", F.col("host"), "block", F.col("host").startswith("adult"), F.lit(0)),
    ]
    entries = None
    for scope, value, action, when, at in dated:
        part = hosts.where(when).select(F.lit(scope).alias("scope"), value.alias("value"), F.lit(action).alias("action"), day(at.cast("int")).alias("since"))
        entries = part if entries is None else entries.unionByName(part)
    return url_filter.filter_urls(captures, entries)


def op10_odd_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_adaptive_scan, op2_lattice_dedup, op3_source_mix, op4_bpe, op5_substring_dedup, op6_line_dedup, op7_main_text,
    op8_language_id, op9_url_filter, op10_odd_minhash)}  # fmt: skip

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

def _reach(links: str) -> str:
    """CTE (node, root) of every node with the smaller nodes that its links reach, itself included."""
    return f"r(node, root) as (select id, id from ids union select {links}.b, r.root from r join {links} on {links}.a = r.node where r.root < {links}.b)"


ORACLE_SQL = {
    "op2_lattice_dedup": f"""
with recursive v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and vec_id is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
n as (select vec_id, e, sqrt(list_dot_product(e, e)) as n from v),
l as (select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
ids as (select distinct vec_id as id from embeddings), {_reach("l")},
c as (select node, min(root) as component_id from r group by node)
select vec_id, coalesce(k.n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from (select distinct vec_id from embeddings) join c on node = vec_id left join (select a, count(*) as n from l group by a) k on k.a = vec_id""",
    "op10_odd_minhash": rf"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') as w from documents),
x as (select doc_id, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) as i from w),
y as (select doc_id, n, i, concat_ws(' ', word, lead(word, 1) over o, lead(word, 2) over o, lead(word, 3) over o, lead(word, 4) over o) as gram from x window o as (partition by doc_id order by i)),
g as materialized (select distinct doc_id, gram from y where i <= greatest(n - 4, 1)),
z as (select doc_id, count(*) as n from g group by doc_id),
m as (select a.doc_id as a, b.doc_id as b, count(*) as n from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id group by all),
l as materialized (select a, b from m join z za on za.doc_id = a join z zb on zb.doc_id = b where 100 * m.n >= 75 * (za.n + zb.n - m.n)),
ids as (select doc_id as id from documents), {_reach("l")},
c as (select node, min(root) as component_id from r group by node)
select d.doc_id, coalesce(z.n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join c on node = d.doc_id left join z on z.doc_id = d.doc_id""",
    "op3_source_mix": r"""
with s as (
  select doc_id, source, case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end::bigint as size
  from documents),
g as (select source, sum(size)::bigint as source_size from s group by source),
w as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from g),
c as (select *, (source_size * 2)::double as cap, (sum(source_size) over ())::double * 1.5 as total from w),
f as (select *, sum(cap) over o - cap as capped, sum(weight) over () - sum(weight) over o + weight as open_ from c
      window o as (order by cap / weight, source nulls last)),
l as (select *, (total - capped) / open_ as level from f),
m as (select arg_min(level, (cap / weight, level)) as final from l where level * weight <= cap),
t as (select source, source_size, case when final is null then cap else least(cap, final * weight) end as target from l, m),
a as (select *, sum(target) over () as all_targets, sum(target) over (order by source nulls last) as upto from t),
b as (select *, (upto - target) / all_targets as low, upto / all_targets as high,
      greatest(1, least(4096, floor(all_targets / 65536)::bigint)) as block from a),
p as (select i as slot, i * 0.6180339887498949::double - floor(i * 0.6180339887498949::double) as u
      from range((select coalesce(max(floor(all_targets / block)::bigint), 0) from b)) r(i)),
e as (select source, low, case when high = max(high) over () then 2.0 else high end as high, block from b where high > low),
k as (select e.source, block, row_number() over (partition by e.source order by slot) - 1 as rank from p join e on u >= low and u < high),
n as (select source, block, count(*) as slots from k group by source, block),
d as (select s.*, b.source_size, b.target, b.block, coalesce(n.slots, 0) * b.block as used,
      sum(s.size) over (partition by s.source order by md5('mix' || coalesce(s.doc_id::varchar, 'null')), s.doc_id) - s.size as start
      from s join b on s.source is not distinct from b.source left join n on s.source is not distinct from n.source)
select doc_id, size, source_size, target,
  (greatest(0, least(start + size, used) - start) + greatest(0, least(start + source_size + size, used) - start - source_size))::bigint as taken
from d""",
    "op6_line_dedup": f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select k.doc_id, count(*)::bigint as n_lines, (count(*) filter (f.key is not null))::bigint as n_dropped,
  sha256(coalesce(string_agg(case when f.key is null then line end, chr(10) order by pos), '')) as kept_sha256
from k left join f on k.key = f.key group by k.doc_id""",
    "op9_url_filter": r"""
with c as (
  select page_id, url, timestamp '2023-01-01' + to_days((page_id % 730)::int) as fetched_at, row_number() over () as row,
    regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1), '\.$', '') as host,
    list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') as steps
  from pages),
h as (select distinct host, length(host) as n from c where host <> ''),
x as (
  select 'h:' || host as key, 'block' as action, n * 37 % 400 as d from h where n % 3 = 0
  union all select 'h:' || host, 'clear', n * 37 % 400 + 200 from h where n % 3 = 0
  union all select 'p:' || host || '/en', 'block', n * 11 % 300 from h where n % 2 = 0
  union all select 'p:' || host || '/en', 'allow', n * 11 % 300 + 250 from h where n % 2 = 0
  union all select 'd:' || regexp_extract(host, '([^.]+\.[^.]+)$', 1), 'block', n * 7 % 500 + 100 from h where n % 5 = 0
  union all select 'd:' || host, 'block', 0 from h where host like 'adult%'),
y as (select key, d, arg_max(action, case action when 'allow' then 2 when 'clear' then 1 else 0 end) as action from x group by key, d),
z as (select key, action, timestamp '2023-01-01' + to_days(d::int) as since,
        timestamp '2023-01-01' + to_days((lead(d) over (partition by key order by d))::int) as until from y),
q as (
  select row, fetched_at, 'h:' || host as key from c where host <> ''
  union all select row, fetched_at, 'd:' || array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
    from c, range(1, 200) r(i) where host <> '' and i <= len(string_split(host, '.'))
  union all select row, fetched_at, 'p:' || host || '/' || array_to_string(list_slice(steps, 1, i), '/')
    from c, range(1, 200) r(i) where host <> '' and i <= len(steps)),
a as (
  select q.row, z.key, z.action,
    row_number() over (partition by q.row order by case left(z.key, 1) when 'p' then 2 when 'h' then 1 else 0 end desc, length(z.key) desc, z.key desc) as turn
  from q join z on q.key = z.key and since <= fetched_at and (until is null or fetched_at < until) where z.action <> 'clear')
select page_id, url, fetched_at, coalesce(action, 'allow') as verdict, key as matched
from c left join a on c.row = a.row and turn = 1""",
}
