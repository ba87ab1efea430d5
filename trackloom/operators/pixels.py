"""Pixel steps on planar 4:2:0 frames, as Arrow-batched numpy: fill, and the check that fills are flat."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILL, MAX_DEV, MAX_STD, ERODE_LUMA, ERODE_CHROMA = 128, 3, 2, 2, 3


def planes(raw: bytes, width: int, height: int) -> list[np.ndarray]:
    n, c = width * height, (width // 2) * (height // 2)
    if width % 2 or height % 2 or len(raw) != n + 2 * c:
        raise ValueError("not a planar 4:2:0 frame of this size")
    a = np.frombuffer(raw, np.uint8).copy()
    return [a[:n].reshape(height, width), a[n : n + c].reshape(height // 2, width // 2), a[n + c :].reshape(height // 2, width // 2)]


def fill(raw: bytes, width: int, height: int, boxes: list[tuple]) -> bytes:
    y, u, v = planes(raw, width, height)
    for x1, y1, x2, y2 in boxes:
        a, b = max(0, math.floor(x1)), max(0, math.floor(y1))
        c, d = min(width, math.ceil(x2)), min(height, math.ceil(y2))
        if c > a and d > b:
            y[b:d, a:c] = FILL
            for p in (u, v):
                p[b // 2 : -(-d // 2), a // 2 : -(-c // 2)] = FILL
    return b"".join(p.tobytes() for p in (y, u, v))


def flat(plane: np.ndarray) -> bool:
    return bool(np.abs(plane.astype(int) - FILL).max() <= MAX_DEV and plane.std() <= MAX_STD)


def integrity(raw: bytes, width: int, height: int, boxes: list[tuple]) -> tuple[int, int, int, int]:
    """(checked, violations, unverifiable, chroma_unverifiable) of a frame's fill boxes, edges eroded. A box too small to
    erode is checked as it is; only an empty one is unverifiable."""
    y, u, v = planes(raw, width, height)
    checked = bad = small = small_chroma = 0
    for x1, y1, x2, y2 in boxes:
        a, b, c, d = max(0, int(x1)), max(0, int(y1)), min(width, int(x2)), min(height, int(y2))
        e = ERODE_LUMA if min(c - a, d - b) > 2 * ERODE_LUMA else 0
        luma = y[b + e : d - e, a + e : c - e] if c > a and d > b else y[:0]
        if luma.size == 0:
            small += 1
            continue
        checked += 1
        ok = flat(luma)
        ca, cb, cc, cd = a // 2 + ERODE_CHROMA, b // 2 + ERODE_CHROMA, c // 2 - ERODE_CHROMA, d // 2 - ERODE_CHROMA
        if cc > ca and cd > cb:
            ok = ok and all(flat(p[cb:cd, ca:cc]) for p in (u, v))
        else:
            small_chroma += 1
        bad += not ok
    return checked, bad, small, small_chroma


def whole_clips(frames: DataFrame, clips: DataFrame) -> DataFrame:
    """clip_id and frames_seen of every clip; one of which not all n_frames frames were decoded is an error, so that a
    short decode never reads as a clean one."""
    seen = F.coalesce("seen", F.lit(0)).cast("long")
    short = F.raise_error(F.concat(F.lit("frames decoded of clip "), F.col("clip_id").cast("string"), F.lit(": "), seen.cast("string"), F.lit(" of "), F.col("n_frames").cast("string")))
    got = clips.join(frames.groupBy("clip_id").agg(F.countDistinct("frame_idx").alias("seen")), "clip_id", "left")
    return got.select("clip_id", F.when(seen == F.col("n_frames"), seen).otherwise(short.cast("long")).alias("frames_seen"))


def redact(frames: DataFrame) -> DataFrame:
    """frames: clip_id, frame_idx, width, height, raw, boxes (array of structs). The same with raw filled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = [fill(r.raw, r.width, r.height, [(b["x1"], b["y1"], b["x2"], b["y2"]) for b in (r.boxes if r.boxes is not None else [])]) for r in pdf.itertuples()]
            yield pdf.assign(raw=raw)

    return frames.mapInPandas(run, frames.schema)
