"""Runs over many clips in which one clip's failure is its own row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSED = ("PASS_AUTOMATED", "PASS_AUTOMATED_NO_YUNET")


def isolated(clips: DataFrame, work: Callable[[dict], str]) -> DataFrame:
    """clip_id, status, error of every clip: work gives the status, or its exception makes the clip FAILED. Each clip is a
    task of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for clip in pdf.to_dict("records"):
                try:
                    out.append((clip["clip_id"], work(clip), None))
                except Exception as e:  # noqa: BLE001  one clip's failure is its own row
                    out.append((clip["clip_id"], "FAILED", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["clip_id", "status", "error"])

    return clips.repartition(min(max(1, clips.count()), 10_000)).mapInPandas(run, "clip_id long, status string, error string")


def _passed(status: Column) -> Column:
    return F.coalesce(status.isin(*PASSED), F.lit(False))


def exit_code(results: DataFrame) -> int:
    """0 only if every clip passed."""
    return int(results.where(~_passed(F.col("status"))).limit(1).count())
