"""Audit of fills: uncovered weak findings, their ranking, a second detector's findings, status with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import geom

ITEM_CAP = 200
MAX_FILL_AREA = 0.5


def uncovered(candidates: DataFrame, fills: DataFrame) -> DataFrame:
    """Candidates that the union of their frame's fill boxes does not cover. The join is on clip and frame; a frame's
    boxes are as many as its tracks."""
    per = fills.groupBy("clip_id", "frame_idx").agg(F.collect_list(geom.box("x1", "y1", "x2", "y2")).alias("boxes"))
    c = candidates.withColumn("b", geom.box("x1", "y1", "x2", "y2")).join(per, ["clip_id", "frame_idx"], "left")
    return c.withColumn("covered", geom.covered("b", "boxes")).where(F.col("covered") < geom.COVERED).drop("b", "boxes")


def threshold(op: dict) -> Column:
    return F.when(F.col("cls") == "face", op["face"]).otherwise(op["lp"])


def sweep(dets: DataFrame, fills: DataFrame, low: float = 0.1, op: dict | None = None) -> DataFrame:
    """Detections from the sweep threshold up to below the operating one that no fill covers."""
    op = op or {"face": 0.30, "lp": 0.40}
    return uncovered(dets.where((F.col("score") >= low) & (F.col("score") < threshold(op))), fills)


def rank_findings(found: DataFrame, op: dict | None = None, cap: int = ITEM_CAP) -> DataFrame:
    """Per clip the first `cap` findings: by score over threshold within a class, classes taking turns, faces first.
    det_seq breaks ties as list order would."""
    op = op or {"face": 0.30, "lp": 0.40}
    w = Window.partitionBy("clip_id", "cls").orderBy(F.desc(F.col("score") / threshold(op)), "det_seq")
    r = found.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= cap)
    turn = Window.partitionBy("clip_id").orderBy("nth", F.col("cls") == "lp")
    return r.withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= cap).drop("nth")


def sweep_totals(found: DataFrame, cap: int = ITEM_CAP) -> DataFrame:
    g = found.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("cls") == "face").alias("n_face"), F.count_if(F.col("cls") == "lp").alias("n_lp"), F.countDistinct("frame_idx").alias("n_frames_hit")
    )
    return g.withColumn("truncated", F.greatest(F.lit(0), F.col("total") - cap).cast("long"))


def second_pass(found: DataFrame, fills: DataFrame, stride: int, least: float = 0.5) -> DataFrame:
    """An independent detector's boxes on sampled frames, at or above `least`, that no fill covers."""
    return uncovered(found.where((F.col("score") >= least) & (F.col("frame_idx") % stride == 0)), fills)


def status(a: DataFrame) -> DataFrame:
    """Reasons in order, and the status they make. a: integrity_ran, checked, violations, sweep_misses, yunet_ran,
    yunet_uncovered, max_fill_area_frac, frames_with_fill, face_frames (null: not supplied), n_frames, dropped_small."""
    none = F.coalesce("face_frames", "frames_with_fill") == 0
    reasons = [
        (F.col("integrity_ran") & (F.col("violations") > 0), F.concat(F.col("violations").cast("string"), F.lit(" fill integrity violations"))),
        (F.col("sweep_misses") > 0, F.concat(F.col("sweep_misses").cast("string"), F.lit(" uncovered weak detections"))),
        (F.col("yunet_ran") & (F.col("yunet_uncovered") > 0), F.concat(F.col("yunet_uncovered").cast("string"), F.lit(" uncovered faces of the second detector"))),
        (~F.col("integrity_ran"), F.lit("fill integrity was not checked")),
        (F.col("max_fill_area_frac") > MAX_FILL_AREA, F.lit("a frame is filled beyond the area limit")),
        (none & (F.col("n_frames") > 0), F.when(F.col("yunet_ran") & (F.col("yunet_uncovered") == 0), F.lit("no face was filled, and the second detector found none")).otherwise(F.lit("no face was filled, and nothing corroborates that"))),
        (F.col("integrity_ran") & (F.col("checked") == 0) & (F.col("frames_with_fill") > 0), F.lit("fills exist but none was checked")),
        (F.col("dropped_small") > 0, F.concat(F.col("dropped_small").cast("string"), F.lit(" detections dropped as too small"))),
    ]
    a = a.withColumn("reasons", F.array_compact(F.array(*[F.when(c, t) for c, t in reasons])))
    ok = F.when(F.col("yunet_ran"), "PASS_AUTOMATED").otherwise("PASS_AUTOMATED_NO_YUNET")
    return a.withColumn("status", F.when(F.size("reasons") > 0, "NEEDS_REVIEW").otherwise(ok))


def run_summary(a: DataFrame) -> DataFrame:
    return a.agg(
        F.count_if(F.col("status").startswith("PASS")).alias("n_pass"), F.count_if(F.col("status") == "NEEDS_REVIEW").alias("n_needs_review"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"), F.array_sort(F.collect_list(F.when(F.col("status") == "FAILED", F.col("clip_id")))).alias("failed_ids"),
    )


def estimate_cost(clips: DataFrame, ms_per_frame: float, detect_hz: float = 10.0, yunet: bool = True, usd_hour: float = 0.16) -> DataFrame:
    """Hours and USD of a run: detection on sampled frames, encoding at 40 fps, decoding at 380 fps, 35 ms per sampled
    frame for the second detector, half an hour fixed. Each clip by its own stride."""
    sampled = F.ceil(F.col("n_frames") / F.greatest(F.lit(1), F.rint(F.col("fps") / detect_hz)))
    g = clips.agg(F.sum(sampled).alias("sampled"), F.sum("n_frames").alias("frames"))
    sec = F.col("sampled") * (ms_per_frame / 1000) + F.col("frames") / 40 + F.col("frames") / 380 + F.col("sampled") * (0.035 if yunet else 0.0)
    g = g.withColumn("hours", F.round(sec / 3600 + 0.5, 6))
    return g.withColumn("usd", F.round(F.col("hours") * usd_hour, 6))


def probe_dump(dets: DataFrame, frames: DataFrame, most: int = 20, op: dict | None = None) -> DataFrame:
    """Frames of a probe to look at, `most` at most: half of them those with the best boxes (any box above its operating
    threshold goes before all others, then by score, then in order), the rest spread evenly over all frames. frames: pos
    (0, 1, ... over the probe), clip_id, frame_idx. A probe is a bounded list, so it is ranked as a whole."""
    op = op or {"face": 0.30, "lp": 0.40}
    best = dets.groupBy("clip_id", "frame_idx").agg(F.max(F.col("score") + (F.col("score") > threshold(op)).cast("int")).alias("best"))
    top = frames.join(best, ["clip_id", "frame_idx"]).orderBy(F.desc("best"), "pos").limit(most // 2).select("pos", "clip_id", "frame_idx")
    step = max(1, frames.count() // max(1, most - top.count()))
    even = frames.where(F.col("pos") % step == 0).select("pos", "clip_id", "frame_idx")
    both = top.withColumn("turn", F.lit(0)).unionByName(even.withColumn("turn", F.lit(1)))
    one = both.groupBy("pos", "clip_id", "frame_idx").agg(F.min("turn").alias("turn"))
    return one.orderBy("turn", "pos").limit(most).select("pos", "clip_id", "frame_idx", (F.col("turn") == 0).alias("by_score")).orderBy("pos")


def probe_frames(clips: DataFrame, total: int, hz: float = 10.0) -> DataFrame:
    """Frames to try a detector on: an even spread over each clip, `total` at most, clips in order."""
    n_clips = clips.count()
    per = max(1, total // max(1, n_clips))
    c = clips.withColumn("stride", F.greatest(F.lit(1), F.rint(F.col("fps") / hz)).cast("long"))
    c = c.withColumn("want", F.least(F.lit(per), F.greatest(F.lit(1), F.floor(F.col("n_frames") / F.col("stride")))).cast("long"))
    c = c.withColumn("span", F.greatest(F.col("stride"), F.floor(F.col("n_frames") / F.col("want"))).cast("long"))
    every = F.when(F.col("n_frames") > 0, F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1, F.col("span")))
    c = c.select("clip_id", F.explode(F.slice(every, F.lit(1), F.col("want").cast("int"))).alias("frame_idx"))
    return c.orderBy("clip_id", "frame_idx").limit(total)
