"""Review lists: flags of both origins, their order, and honest accounts of what a page leaves out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAFE_ID = r"^[A-Za-z0-9._-]{1,64}$"
PAGE_LIMIT = 200


def flags(sweep: DataFrame, second: DataFrame) -> DataFrame:
    """Findings of the sweep and of the second detector with their origin; malformed ones (no frame or box) are marked."""
    cols = ["clip_id", "frame_idx", "cls", "score", "x1", "y1", "x2", "y2", "det_seq"]
    both = sweep.select(F.lit("sweep").alias("origin"), *cols).unionByName(second.select(F.lit("yunet").alias("origin"), *cols))
    bad = F.col("frame_idx").isNull() | F.col("x1").isNull() | F.col("y1").isNull() | F.col("x2").isNull() | F.col("y2").isNull()
    return both.withColumn("malformed", bad)


def order_flags(f: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """Per clip: the second detector's flags first, then by falling score, in list order; limit 0 shows all."""
    w = Window.partitionBy("clip_id").orderBy(F.col("origin") != "yunet", F.desc("score"), "det_seq")
    r = f.where(~F.col("malformed")).withColumn("pos", F.row_number().over(w))
    return r.where(F.col("pos") <= limit) if limit else r


def accounting(f: DataFrame, withheld: DataFrame, limit: int = PAGE_LIMIT) -> DataFrame:
    """Per clip: flagged = collected + withheld by the audit's cap; shown under the page's limit; the rest truncated.
    withheld: clip_id, withheld."""
    g = f.groupBy("clip_id").agg(F.count_if(~F.col("malformed")).alias("collected"), F.count_if("malformed").alias("malformed"))
    g = g.join(withheld, "clip_id", "full").na.fill(0, ["collected", "malformed", "withheld"])
    shown = F.col("collected") if limit == 0 else F.least(F.col("collected"), F.lit(limit))
    g = g.withColumn("flagged", F.col("collected") + F.col("withheld")).withColumn("shown", shown.cast("long"))
    return g.withColumn("truncated", F.col("flagged") - F.col("shown"))


def usable(manifests: DataFrame, every: bool = False) -> DataFrame:
    """Manifests with the reason for which one is skipped, if any. manifests: clip_id, output_path, status, fps, width,
    height."""
    name = F.col("output_path")
    reason = (
        F.when(~F.coalesce(F.col("clip_id").cast("string").rlike(SAFE_ID), F.lit(False)), "unsafe clip id")
        .when(name.contains("/") | name.contains("\\") | name.startswith("."), "unsafe output path")
        .when(~F.coalesce((F.col("fps") > 0) & (F.col("width") > 0) & (F.col("height") > 0), F.lit(False)), "unusable geometry")
    )
    if not every:
        reason = reason.when(F.col("status") == "PASS_AUTOMATED", "passed")
    return manifests.withColumn("skipped", reason)


def html_page(clip_id: str, rows: list[dict], account: dict, failed: int = 0) -> str:
    """A review page of a clip: what is shown, flagged, truncated and failed is always said, and nothing is called
    clean where something failed."""
    from html import escape

    head = f"{account['shown'] - failed} shown, {account['flagged']} flagged, {failed} failed, {account['truncated']} truncated"
    if not rows and not failed and not account["flagged"]:
        body = "<p>No findings.</p>"
    else:
        body = "".join(f"<li>#{i} frame {r['frame_idx']} {escape(str(r['origin']))} {escape(str(r['cls']))} {r['score']:.3f}</li>" for i, r in enumerate(rows))
        body = f"<ol>{body}</ol>"
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{escape(clip_id)}</title></head><body><h1>{escape(clip_id)}</h1><p>{head}</p>{body}</body></html>"
