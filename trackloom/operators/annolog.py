"""The annotation log: append-only rows, latest write per key wins, resumable.

A key is (video_id, unit_idx, stage, model_id). Writing appends; the current state is the row with the highest
write_seq of each key, found by a partial aggregate (max_by), so a key that is written very often costs one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["video_id", "unit_idx", "stage", "model_id"]


def latest(log: DataFrame) -> DataFrame:
    rest = [c for c in log.columns if c not in KEY]
    return log.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "write_seq").alias("row")).select(*KEY, *[F.col("row")[c].alias(c) for c in rest])


def point(log: DataFrame, video_id: object, unit_idx: int, stage: str, model_id: str) -> DataFrame:
    """The current row of one key."""
    return latest(log.where((F.col("video_id") == video_id) & (F.col("unit_idx") == unit_idx) & (F.col("stage") == stage) & (F.col("model_id") == model_id)))


def scan_stage(log: DataFrame, stage: str, model_id: str | None = None) -> DataFrame:
    """Current rows of a stage by video and unit; all models unless one is named (then model_id breaks ties)."""
    sel = log.where(F.col("stage") == stage)
    if model_id is not None:
        sel = sel.where(F.col("model_id") == model_id)
    return latest(sel).orderBy("video_id", "unit_idx", "model_id")


def done(log: DataFrame, stage: str, model_id: str) -> DataFrame:
    """Units that need no further run: those whose current row has no error."""
    return scan_rows(log, stage, model_id).where("error is null").select("video_id", "unit_idx")


def scan_rows(log: DataFrame, stage: str, model_id: str) -> DataFrame:
    return latest(log.where((F.col("stage") == stage) & (F.col("model_id") == model_id)))


def pending(units: DataFrame, log: DataFrame, stage: str, model_id: str) -> DataFrame:
    """Units (video_id, unit_idx) still to be run."""
    return units.join(done(log, stage, model_id), ["video_id", "unit_idx"], "left_anti")


def agreement(log: DataFrame, one: str, other: str) -> DataFrame:
    """Current rows of two models on the same unit side by side."""
    cur = latest(log)
    a = cur.where(F.col("model_id") == one).select("video_id", "unit_idx", "stage", F.col("error").alias("error_a"), F.col("write_seq").alias("seq_a"))
    b = cur.where(F.col("model_id") == other).select("video_id", "unit_idx", "stage", F.col("error").alias("error_b"), F.col("write_seq").alias("seq_b"))
    both = a.join(b, ["video_id", "unit_idx", "stage"])
    return both.withColumn("both_fine", F.col("error_a").isNull() & F.col("error_b").isNull())
