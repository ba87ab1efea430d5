"""Runs and windows over dense frame series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import WINDOW_FRAMES, window_clock


def gaps(frames: DataFrame) -> DataFrame:
    """Runs of frames without hands, one row each (gaps and islands). frames: video_id, frame_idx, timestamp_ms,
    hands_present. A run's duration is last minus first timestamp, its count goes by frame index."""
    w = Window.partitionBy("video_id").orderBy("frame_idx")
    f = frames.withColumn("absent", F.col("hands_present") == 0)
    f = f.withColumn("run", F.sum(F.when(F.col("absent") & F.lag("absent", 1, False).over(w), 0).otherwise(1)).over(w))
    g = f.where("absent").groupBy("video_id", "run").agg(
        F.min("frame_idx").alias("start_frame"), F.max("frame_idx").alias("end_frame"),
        F.min_by("timestamp_ms", "frame_idx").alias("start_ms"), F.max_by("timestamp_ms", "frame_idx").alias("end_ms"),
    )
    return g.select("video_id", "start_frame", "end_frame", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), (F.col("end_frame") - F.col("start_frame") + 1).alias("n_frames"))


def tiles(frames: DataFrame, size: int = WINDOW_FRAMES) -> DataFrame:
    """Tumbling windows of `size` frames with their clock; the last one may be partial."""
    g = frames.groupBy("video_id", F.floor(F.col("frame_idx") / size).cast("long").alias("window_idx"))
    g = g.agg(F.array_sort(F.collect_list("frame_idx")).alias("frame_indices"))
    start, end = window_clock(F.col("frame_indices")[0], F.element_at("frame_indices", -1))
    return g.select("video_id", "window_idx", "frame_indices", (F.size("frame_indices") < size).alias("is_partial"), start.alias("start_ms"), end.alias("end_ms"))


def sample_frames(frames: DataFrame, fps: float, target: float = 15.0) -> DataFrame:
    """Every stride-th source frame, with dense numbers and timestamps from the source number."""
    step = max(1, round(fps / target))
    f = frames.where(F.col("source_idx") % step == 0)
    return f.withColumn("frame_idx", (F.col("source_idx") / step).cast("long")).withColumn("timestamp_ms", F.rint(F.col("source_idx") / F.lit(float(fps)) * 1000).cast("long"))


def presence(frames: DataFrame) -> DataFrame:
    """Frames, and frames with a hand, of each video."""
    return frames.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_frames"), F.count_if(F.col("hands_present") > 0).alias("n_with_hands"))


def boundaries(actions: DataFrame) -> DataFrame:
    """Candidate boundaries between consecutive actions of a video, within a window or at a seam of two. actions:
    video_id, window_idx, pos, task_step, start_frame."""
    w = Window.partitionBy("video_id").orderBy("window_idx", "pos")
    a = actions.withColumn("before", F.lag("task_step").over(w)).withColumn("before_window", F.lag("window_idx").over(w))
    source = F.when(F.col("before_window") == F.col("window_idx"), "intra_window").otherwise("window_seam")
    return a.where("before_window is not null").select("video_id", "window_idx", "pos", F.col("before").alias("from_step"), F.col("task_step").alias("to_step"), source.alias("boundary_source"))
