"""Line dedup by site-relative frequency.

Lines of a page are what its markup separates (block tags break lines; scripts, styles, comments and other tags go).
For each host the pages that hold a line are counted and divided by the host's pages; lines that more than `percent` of
a hundred pages hold, and at least `least` pages, are boilerplate and dropped from every page of that host. The share is
compared in whole numbers, so a line at the ratio itself stays, on every host alike. `least` only says that a line must
repeat at all: from 20 pages on the share alone decides.

Counting shuffles a 64-bit hash a line, combined before the shuffle. A host's boilerplate is a short list: a page of
k lines has at most k of the lines that more than a share r of pages hold, so a host has at most k/r of them, whatever
its size; the list goes back to the pages by an equi-join on the host whose page side may be split. A page meets its
host's list once, by a hash set of the list's numbers, and its lines then meet only what both have. No page is grouped.

Cases: null markup and empty pages have no lines and an empty text; a url without host belongs to the host ''; repeated
rows are pages of their own; a host with fewer than `least` pages loses nothing; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .url_filter import host_of

#: A tenth of a site's pages: what stands on fewer is an article's own line, or one that related pages quote.
PERCENT = 10
LEAST = 2

_BLOCK = r"(?i)</?(p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|nav|main|aside|article|section|header|footer|title|head|body|html|table|thead|tbody|tr|td|th|pre|blockquote|form|option)\b[^>]*>"
#: In this order.
_REWRITES = (
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (_BLOCK, "\n"),
    (r"<[^>]*>", ""),
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
)
_TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def lines_of(html: Column) -> Column:
    for pattern, to in _REWRITES:
        html = F.regexp_replace(html, pattern, to)
    return F.filter(F.transform(F.split(F.coalesce(html, F.lit("")), "\n"), lambda x: F.regexp_replace(x, _TRIM, "")), lambda x: x != "")


def drop_boilerplate(pages: DataFrame, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """page_id, host, text (the lines that stay), n_lines, n_dropped."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
    p = cut(p, "lines")  # the markup is read once
    keys = F.transform("lines", lambda x: F.xxhash64(x))
    seen = p.select("host", F.explode(F.array_distinct(keys)).alias("k")).groupBy("host", "k").agg(F.count(F.lit(1)).alias("n"))
    total = p.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least)
    often = seen.where(F.col("n") >= least).join(total, "host").where(100 * F.col("n") > percent * F.col("pages"))
    # Written, so that the join deals its two sides itself: only then may Spark split the pages of a hot host.
    stale = cut(often.groupBy("host").agg(F.collect_set("k").alias("stale")), "stale")
    out = p.join(stale, "host", "left").withColumn("stale", F.coalesce("stale", F.array().cast("array<bigint>")))
    # The one-element transform binds what page and list have in common, so it is made once a page.
    hits = F.array(F.array_intersect(keys, "stale"))
    out = out.withColumn("stay", F.transform(hits, lambda h: F.filter("lines", lambda x: ~F.array_contains(h, F.xxhash64(x))))[0])
    return out.select("page_id", "host", F.array_join("stay", "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "pages"))


def _sql_lines() -> str:
    x = "html"
    for pattern, to in _REWRITES:
        x = f"regexp_replace({x}, '{pattern}', {'chr(10)' if to == chr(10) else repr(to)}, 'g')"
    return f"list_filter(list_transform(string_split(coalesce({x}, ''), chr(10)), lambda x: regexp_replace(x, '{_TRIM}', '', 'g')), lambda x: x <> '')"


SQL = rf"""
with p as (
  select page_id, row_number() over () as rid, {_sql_lines()} as lines,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
  from pages),
seen as (select host, line, count(*) as n from (select host, rid, unnest(list_distinct(lines)) as line from p) group by host, line),
total as (select host, count(*) as pages from p group by host),
stale as (select seen.host, list(line) as stale from seen join total on seen.host = total.host where n >= {LEAST} and 100 * n > {PERCENT} * pages group by seen.host),
o as (select page_id, p.host, lines, list_filter(lines, lambda x: not list_contains(coalesce(stale, []), x)) as stay from p left join stale on p.host = stale.host)
select page_id, host, array_to_string(stay, chr(10)) as text, len(lines)::bigint as n_lines, (len(lines) - len(stay))::bigint as n_dropped from o
"""
