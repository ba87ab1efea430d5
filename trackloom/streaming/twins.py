"""Streaming forms of the stateful operators. Batch and stream give the same rows once the input has ended.

An end-of-input row (frame_idx null) closes a video's open run.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from ..operators import hands, tracks

GAP = "video_id long, start_frame long, end_frame long, start_ms long, end_ms long, duration_ms long, n_frames long"
_OPEN = "start_frame long, end_frame long, start_ms long, end_ms long"


def _feed(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    run = state.get if state.exists else None
    rows = pd.concat(list(batches)).sort_values("frame_idx", na_position="last")
    out = []

    def close() -> None:
        s, e, a, b = run
        out.append((int(key[0]), s, e, a, b, b - a, e - s + 1))

    for f, ms, present in zip(rows["frame_idx"], rows["timestamp_ms"], rows["hands_present"]):
        if pd.isna(f) or present > 0:
            if run is not None:
                close()
                run = None
        else:
            f, ms = int(f), int(ms)
            run = (run[0], f, run[2], ms) if run is not None else (f, f, ms, ms)
    if run is not None:
        state.update(tuple(run))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(out, columns=[c.split()[0] for c in GAP.split(", ")])


def gaps_stream(frames: DataFrame) -> DataFrame:
    """Gaps of an unbounded series; within a trigger frames may come in any order, across triggers they are in order."""
    return frames.groupBy("video_id").applyInPandasWithState(_feed, GAP, _OPEN, "append", GroupStateTimeout.NoTimeout)


def tiles_stream(frames: DataFrame, size: int = 8) -> DataFrame:
    """Counts of the tumbling windows as they fill (update mode)."""
    return frames.groupBy("video_id", F.floor(F.col("frame_idx") / size).cast("long").alias("window_idx")).agg(F.count(F.lit(1)).alias("n_frames"), F.min("frame_idx").alias("first"), F.max("frame_idx").alias("last"))


HAND = "video_id long, frame_idx long, left_x double, right_x double, left_track_id int, right_track_id int, hands_present int"
_SLOTS = "lx double, ly double, rx double, ry double, lt int, rt int, next_id int"


def _apart(p: tuple | None, q: tuple) -> float:
    return 0.0 if p is None else ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5


def slots(found: list[tuple], left: tuple | None, right: tuple | None, most: float) -> tuple[tuple | None, tuple | None]:
    """Which of a frame's hands ((x, y), label) goes left and which right, given the points of the frame before."""
    if not found:
        return None, None
    (a, label), known = found[0], left is not None or right is not None
    if len(found) == 1:
        if left is not None and right is not None:
            goes_left = _apart(left, a) <= _apart(right, a)
        elif left is not None:
            goes_left = _apart(left, a) <= most
        else:
            goes_left = not _apart(right, a) <= most if known else label == "Left"
        return (a, None) if goes_left else (None, a)
    b, other = found[1]
    if known:
        straight = _apart(left, a) + _apart(right, b) <= _apart(left, b) + _apart(right, a)
    elif (label == "Left") != (other == "Left"):
        straight = label == "Left"
    else:
        straight = a[0] <= b[0]
    return (a, b) if straight else (b, a)


def hands_stream(dets: DataFrame, max_delta: float = hands.MAX_DELTA) -> DataFrame:
    """Hand slots of an unbounded series, rows as for `hands.assign`. A frame's rows come in one trigger; within it frames
    may come in any order, across triggers they are in order."""

    def feed(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lx, ly, rx, ry, lt, rt, new = state.get if state.exists else (None, None, None, None, None, None, 0)
        left, right = (None if lx is None else (lx, ly)), (None if rx is None else (rx, ry))
        out = []
        for frame, rows in pd.concat(list(batches)).sort_values(["frame_idx", "det_seq"]).groupby("frame_idx"):
            found = [((float(x), float(y)), label) for s, n, x, y, label in zip(rows["det_seq"], rows["n_det"], rows["x"], rows["y"], rows["label"]) if s < n]
            ids, ends = [], slots(found, left, right, max_delta)
            for point, last, held in ((ends[0], left, lt), (ends[1], right, rt)):
                jumped = point is not None and len(found) > 1 and last is not None and _apart(last, point) > max_delta
                held = None if jumped or point is None else held
                if point is not None and held is None:
                    held, new = new, new + 1
                ids.append(held)
            (left, right), (lt, rt) = ends, ids
            out.append((int(key[0]), int(frame), left and left[0], right and right[0], lt, rt, (left is not None) + (right is not None)))
        state.update((*(left or (None, None)), *(right or (None, None)), lt, rt, new))
        res = pd.DataFrame(out, columns=[c.split()[0] for c in HAND.split(", ")])
        yield res.astype({"left_track_id": "Int32", "right_track_id": "Int32", "left_x": "Float64", "right_x": "Float64"})

    return dets.groupBy("video_id").applyInPandasWithState(feed, HAND, _SLOTS, "append", GroupStateTimeout.NoTimeout)


def tracks_stream(dets: DataFrame, rules: tracks.TrackRules) -> DataFrame:
    """Matched detections of an unbounded series, rows as for `tracks.build_tracks`. A frame's detections come in one
    trigger; across triggers frames are in order. The state is the live tracks."""

    def feed(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        live = json.loads(state.get[0]) if state.exists else {}
        rows = tracks.match_clip(pd.concat(list(batches)).sort_values("det_seq", kind="stable"), rules, live)
        state.update((json.dumps(live, default=lambda x: x.item()),))
        yield pd.DataFrame([(key[0], *r) for r in rows], columns=[c.split()[0] for c in tracks.SCHEMA.split(", ")])

    kept, _ = tracks.split_small(tracks.operating(dets, rules), rules)
    return kept.groupBy("clip_id").applyInPandasWithState(feed, tracks.SCHEMA, "live string", "append", GroupStateTimeout.NoTimeout)


def upsert_writer(path: str):
    """foreachBatch sink of the annotation log: appends the batch, numbered so that later writes win."""

    def write(batch: DataFrame, epoch: int) -> None:
        seq = F.lit(epoch).cast("long") * F.lit(1 << 40) + F.row_number().over(Window.partitionBy("video_id", "unit_idx", "stage", "model_id").orderBy("write_seq"))
        batch.withColumn("write_seq", seq.cast("long")).write.mode("append").parquet(path)

    return write
