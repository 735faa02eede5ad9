"""Entity views over the public test tables, in SQL that Spark and DuckDB both read.

customers: S1 is every customer; S2 and S3 rewrite the names and addresses of every second and third one, so the
truth is known. documents: first line and whole rest of every document, dealt to the three sources by
id. parts: few distinct names, so keys are hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_W1 = "translate(cast(c_custkey * 7919 % 100003 as string), '0123456789', 'aeioubdgkm')"
_W2 = "translate(cast(c_custkey * 104729 % 9973 as string), '0123456789', 'rstlnpaeio')"
_NO = "cast(c_custkey * 31 % 997 as string)"
_KEY = "cast(c_custkey as string)"

CUSTOMERS = {
    "s1": f"""select 'S1-' || {_KEY} as entity_id, {_W1} || ' ' || {_W2} || ' Trading Co.' as business_name,
  {_NO} || ' ' || n_name || ' Rd. ' || c_mktsegment as business_address, n_name as country
  from customer join nation on c_nationkey = n_nationkey""",
    "s2": f"""select 'S2-' || {_KEY} as entity_id,
  case when c_custkey % 4 = 0 then upper({_W1}) || '  ' || {_W2} || ' TRADING, CO' else {_W1} || ' ' || {_W2} || ' trading company' end as business_name,
  {_NO} || ' ' || n_name || ' Road ' || c_mktsegment as business_address, n_name as country
  from customer join nation on c_nationkey = n_nationkey where c_custkey % 2 = 0""",
    "s3": f"""select 'S3-' || {_KEY} as entity_id,
  case when c_custkey % 9 = 0 then '' when c_custkey % 6 = 0 then replace({_W1}, 'a', 'á') || ' ' || {_W2} || ' Trading Co' else {_W2} || ' ' || {_W1} || ' & Trading' end as business_name,
  n_name || ' ' || c_mktsegment || ' ' || {_NO} as business_address, n_name as country
  from customer join nation on c_nationkey = n_nationkey where c_custkey % 3 = 0""",
    "truth": f"""select 'S1-' || {_KEY} as source1_entity_id,
  case when c_custkey % 6 = 0 then 'S2-' || {_KEY} || ',S3-' || {_KEY} when c_custkey % 2 = 0 then 'S2-' || {_KEY}
       when c_custkey % 3 = 0 then 'S3-' || {_KEY} else '' end as matched_entity_ids
  from customer""",
    # Candidates: each customer with its own and the next record of either source.
    "cand": """select 'S1-' || cast(k as string) as s1_id, p || cast(j as string) as candidate_id from (
  select c_custkey as k, 'S2-' as p, c_custkey - c_custkey % 2 as j from customer
  union all select c_custkey, 'S2-', c_custkey - c_custkey % 2 + 2 from customer
  union all select c_custkey, 'S3-', c_custkey - c_custkey % 3 + 3 from customer
  union all select c_custkey, 'S3-', c_custkey - c_custkey % 3 from customer where c_custkey % 5 <> 0) x
  where j <= (select max(c_custkey) from customer)""",
}

_FIRST = "split_part(text, chr(10), 1)"
_REST = f"substr(text, length({_FIRST}) + 2)"
DOCUMENTS = {
    f"s{i + 1}": f"""select 'S{i + 1}-' || cast(doc_id as string) as entity_id, {_FIRST} as business_name, {_REST} as business_address,
  lang as country from documents where doc_id % 3 = {i}"""
    for i in range(3)
}
PARTS = {
    f"s{i + 1}": f"""select 'S{i + 1}-' || cast(p_partkey as string) as entity_id, p_name as business_name, p_brand || ' ' || p_type as business_address,
  'anywhere' as country from part where p_partkey % 3 = {i}"""
    for i in range(3)
}
def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the Parquet tables that it names."""
    frames = {}
    for name in ("customer", "nation", "documents", "part", "supplier"):
        token = f"{{{name}}}"
        replaced = _names(sql, name, token)
        if replaced != sql:
            sql = replaced
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(sql, **frames)


def _names(sql: str, name: str, token: str) -> str:
    import re

    return re.sub(rf"\b(from|join) {name}\b", lambda m: f"{m[1]} {token}", sql)
