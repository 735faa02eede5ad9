"""URL filters as a temporal list join, DataFrame functions only.

A list entry says what holds for a host, a domain with its subdomains, or a URL prefix from its date on: ``block``,
``allow``, or ``clear`` to end what held before. Dated entries of one value become validity intervals; the
as-of join matches every capture with the entries active when it was fetched.

Scale: a capture meets the list on a handful of exact keys (its host, parent domains, path prefixes), so the
join is an equi-join. Keys that no entry names, as most are, are dropped by a bitmap of the list's keys where they arise. The
intervals are a table of their own, so that the join can split a key with very many captures. Verdicts are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import roughly_among, written


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if the URL has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.regexp_replace(host, r"\.$", "")


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def url_keys(url: Column) -> Column:
    """Keys on which a list can name a URL (null, or without a host: none): ``h:host``, ``d:`` it and its parents, ``p:host/path/`` prefixes by segment."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    steps = F.filter(F.split(path, "/", -1), lambda s: s != "")
    none = F.array().cast("array<string>")
    prefixes = F.when(F.size(steps) == 0, none).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(steps), F.lit(1))),
        lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/"))))
    keys = F.concat(F.array(F.concat(F.lit("h:"), host)), parents, prefixes)
    return F.when(url.isNull() | (host == ""), none).otherwise(keys)


def intervals(entries: DataFrame) -> DataFrame:
    """``key, action, since, until`` of dated entries ``scope, value, action, since``.

    scope: host, domain or prefix. Entries of one key with the same date: the last action in the order block,
    clear, allow holds. Entries with a null field or an unknown scope or action say nothing; repeated entries say it once; no
    entries give no intervals. Other columns are not read.
    """
    letter = F.when(F.col("scope") == "host", "h:").when(F.col("scope") == "domain", "d:").when(F.col("scope") == "prefix", "p:")
    e = entries.where(F.col("action").isin("block", "allow", "clear"))
    e = e.select(F.concat(letter, F.regexp_replace("value", "/+$", "")).alias("key"), "action", "since")
    e = e.where("key is not null and since is not null")
    weight = F.when(F.col("action") == "allow", 2).when(F.col("action") == "clear", 1).otherwise(0)
    e = e.groupBy("key", "since").agg(F.max_by("action", weight).alias("action"))
    order = Window.partitionBy("key").orderBy("since")
    return e.withColumn("until", F.lead("since").over(order)).where("action <> 'clear'")


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Verdict of every capture: its columns ``page_id, url, fetched_at``, and ``verdict, matched``.

    The most specific active entry decides: a prefix before a host before a domain, longer before shorter.
    verdict: block or allow; ``allow`` with null ``matched`` where no entry is active, the URL is null or has no host, or
    the fetch time is null. An entry is active from its date on, until the next one of its value.
    Repeated captures stay repeated. Other columns are not read. No captures give no rows.
    """
    rows = captures.select("page_id", F.col("url").cast("string").alias("url"), F.col("fetched_at").cast("timestamp").alias("fetched_at"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "captures")
    keyed = rows.select("row", "fetched_at", F.explode(url_keys(F.col("url"))).alias("key"))
    spans = written(intervals(entries), "intervals")
    active = roughly_among(keyed, spans.select("key"), "key").join(spans, "key").where("since <= fetched_at and (until is null or fetched_at < until)")
    kind = F.when(F.col("key").startswith("p:"), 2).when(F.col("key").startswith("h:"), 1).otherwise(0)
    decided = active.groupBy("row").agg(F.max(F.struct(kind.alias("kind"), F.length("key").alias("n"), "key", "action")).alias("top"))
    out = rows.join(decided, "row", "left")
    return out.select("page_id", "url", "fetched_at", F.coalesce("top.action", F.lit("allow")).alias("verdict"), F.col("top.key").alias("matched"))
