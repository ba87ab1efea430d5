"""Exact duplicates by distributed MSD radix partitioning.

The digits of a text are slices of its normalised UTF-8 bytes, most significant first: 64 bytes, then slices that
grow eightfold. Each level groups the open documents by (group, digit); a group of one document, and a group whose
texts end in this digit, is settled, and only the others go on with the rest of their bytes. Texts meet by their
bytes alone; the SHA-256 in the result takes no part in the comparison.

Per level one aggregate (combined before the shuffle, so a huge group costs one row a task) and one equi-join on
(group, digit), whose document side may be split where a group is hot. Rows that are settled carry no text further.

Cases: a null text is an empty text, and empty texts equal each other; a null id sorts after all others; of repeated
rows (same id and text) one stays; other columns are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_RUN, bloom_blocks, bloom_probe, bloom_table, cut, drop, table

FIRST_BYTES = 64
GROWTH = 8


def normalised(text: Column) -> Column:
    """Every run of white space becomes one space; a lone space is left alone, so that the common case copies nothing."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    raw = docs.select(F.col(id_col).alias("doc_id"), F.encode(normalised(F.col(text_col)), "UTF-8").alias("b"))
    head = lambda width: (F.substring("b", 1, width).alias("digit"), (F.octet_length("b") <= width).alias("ended"))

    def groups(d: DataFrame, keys: list[str]) -> DataFrame:
        g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keep_id")).where("n > 1")
        return cut(g.withColumn("gid", F.monotonically_increasing_id()), "radix-groups")

    def settle(d: DataFrame, g: DataFrame, keys: list[str], width: int) -> DataFrame:
        """Rows with their group; `rest` is null as soon as a row is settled."""
        open_ = F.col("n").isNotNull() & ~F.col("ended")
        j = d.join(g.hint("merge"), keys, "left")
        return j.select(
            "uid", "doc_id", "sha", F.when(F.col("n").isNotNull(), F.col("gid")).alias("gid"),
            F.coalesce("n", F.lit(1)).cast("long").alias("n"), F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(open_, F.expr(f"substring(b, {width + 1})")).alias("rest"),
        )

    width, level = first, 0
    g = groups(raw.select("doc_id", *head(width)), ["digit", "ended"])
    d = raw.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "b", F.sha2("b", 256).alias("sha"), *head(width))
    # Most texts share their first digit with none. A Bloom filter of the shared ones (of bounded size) tells most of them
    # before the shuffle, so their text stays where it is; the join decides.
    blocks = bloom_blocks(g.count())
    shared = bloom_table(g, F.col("digit"), blocks)
    d = d.select("*", *bloom_probe(F.col("digit"), blocks)).join(F.broadcast(shared), "block", "left")
    d = d.withColumn("b", F.when(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits"), F.col("b"))).drop("block", "bits", "word")
    cur = cut(settle(d, g, ["digit", "ended"], width), "radix-0")
    drop(g)
    done = [cur.where("rest is null").drop("rest").withColumn("level", F.lit(0))]
    while not cur.where("rest is not null").isEmpty():
        level, width = level + 1, width * growth
        d = cur.where("rest is not null").select("uid", "doc_id", "sha", F.col("gid").alias("parent"), F.col("rest").alias("b"))
        d = d.select("*", *head(width))
        keys = ["parent", "digit", "ended"]
        g = groups(d.select("doc_id", *keys), keys)
        nxt = cut(settle(d, g, keys, width), f"radix-{level}")
        drop(g)
        cur = nxt
        done.append(cur.where("rest is null").drop("rest").withColumn("level", F.lit(level)))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    # Of several rows that carry the smallest id of their group (repeated rows, null ids), one stays.
    first_rows = out.where("n > 1 and doc_id <=> keep_id")
    ties = first_rows.groupBy("level", "gid").agg(F.min("uid").alias("stays"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    kept = (F.col("n") == 1) | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if not ties.isEmpty():
        out = out.join(cut(ties, "radix-ties"), ["level", "gid"], "left")
        kept = kept & (F.col("stays").isNull() | (F.col("stays") == F.col("uid")))
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, whole. Ids are taken as unique; of rows that share id and text one stays."""
    keep = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("_keep"))
    twice = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").isEmpty()
    src = docs if twice else docs.dropDuplicates(["doc_id", "text"])
    return src.join(keep.distinct(), src["doc_id"].eqNullSafe(F.col("_keep")), "left_semi").select(*docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select t, min(doc_id) as keep_id, count(*) as group_size from d group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t
"""
assert WS_RUN in SQL
