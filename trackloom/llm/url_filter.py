"""URL filter: a blocked Bloom filter of the listed canonical URLs, then an exact hash join.

A listed URL is host/path; it fits its host and all subdomains where the path starts with its own, and the longest one
that fits decides. The host suffixes of each distinct URL meet the listed hosts (a Bloom filter, then an equi-join), which
tell how long their listed paths are; only those prefixes of the URL's path make canonical URLs to look up. Each first
meets one 64-bit block of the filter of listed URLs (a table of a fixed largest number of blocks, so it may be
broadcast); the few that pass meet the list itself in an equi-join, which removes the false positives. So the plan has
one size whatever the list. URLs that no listed one fits get the default verdict.

Cases: a null url or one without :// has empty host and path and the default verdict; repeated rows and null ids are
judged each; extra columns are not read; an empty list lets everything through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bloom_blocks, bloom_probe, bloom_table, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the query: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict. listed: host, path, verdict."""
    rules = listed.where("host is not null and path is not null").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.select("host", F.concat("host", "path").alias("rule"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("len"))
    p = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    n_rules, deepest = rules.agg(F.count(F.lit(1)), F.coalesce(F.max("labels"), F.lit(0))).first()
    blocks = bloom_blocks(n_rules)

    def passed(rows: DataFrame, key: str, listed_keys: DataFrame) -> DataFrame:
        bloom = bloom_table(listed_keys, F.col(key), blocks)
        some = rows.select("*", *bloom_probe(F.col(key), blocks)).join(F.broadcast(bloom), "block")
        return some.where(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits")).drop("block", "bits", "word")

    hosts = rules.groupBy(F.col("host").alias("site")).agg(F.collect_set("len").alias("lens"))
    urls = p.where("host <> ''").select("url", "host", "path").distinct()
    label = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(label), F.lit(max(1, deepest)))), lambda n: F.array_join(F.slice(label, -n, n), "."))
    cand = passed(urls.select("url", "path", F.explode(suffixes).alias("site")), "site", hosts).join(hosts, "site")
    cand = cand.select("url", "path", "site", F.explode("lens").alias("len")).where(F.length("path") >= F.col("len"))
    cand = cand.select("url", F.concat("site", F.expr("substring(path, 1, len)")).alias("rule"))
    hits = passed(cand, "rule", rules).join(rules, "rule").groupBy("url")
    hits = hits.agg(F.max(F.struct(F.length("rule").alias("n"), "labels", "rule", "verdict")).alias("hit"))
    out = p.join(hits, "url", "left")
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
    return judge(table(spark, sf_dir, "pages"), spark.sql(f"select * from values {values} as t(host, path, verdict)"))


SQL = r"""
with p as (
  select page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r(rhost, rpath, rverdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j as (
  select p.*, (select max_by(struct_pack(rule := rhost || rpath, verdict := rverdict), length(rhost || rpath)) from r
               where (p.host = rhost or ends_with(p.host, '.' || rhost)) and starts_with(p.path, rpath)) as hit
  from p)
select page_id, host, path, hit.rule as rule, coalesce(hit.verdict, 'allow') as verdict from j
"""
