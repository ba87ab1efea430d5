"""Detectors over frames: their contract, their choice, what they are shown and what is kept of their answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pixels

DETECTION = "struct<cls:string,x1:double,y1:double,x2:double,y2:double,score:double>"
ATTEMPT = f"clip_id long, frame_idx long, detections array<{DETECTION}>"


@dataclass(frozen=True)
class Detection:
    frame_idx: int
    cls: str
    x1: float
    y1: float
    x2: float
    y2: float
    score: float


class Detector(Protocol):
    def detect_batch(self, images: list[np.ndarray], idxs: list[int]) -> list[Detection]: ...


class OneByOne:
    """A detector of single images, behind the contract of batches."""

    def __init__(self, detect: Callable[[np.ndarray, int], list[Detection]]) -> None:
        self.detect = detect

    def detect_batch(self, images: list[np.ndarray], idxs: list[int]) -> list[Detection]:
        return [d for image, i in zip(images, idxs) for d in self.detect(image, i)]


def choose(generation: str, face: dict[str, object], plate: dict[str, object]) -> tuple[str, object, object | None]:
    """(generation, face weights, plate weights or None), settled before the run. face and plate: weights by generation
    "1" and "2". "auto" takes the newer one that has face weights; face weights are a must, plates may go unchecked,
    which the audit then says."""
    tried = ("2", "1") if generation == "auto" else (generation,)
    for g in tried:
        if g not in ("1", "2"):
            raise ValueError(f"no generation {g}")
        if face.get(g) is not None:
            return g, face[g], plate.get(g)
    raise ValueError(f"no face weights for generation {generation}")


def image(raw: bytes, width: int, height: int, full_range: bool) -> np.ndarray:
    """Blue, green and red as a detector sees them: BT.601, whose inverse is that of limited range, so samples of full
    range are brought there first. Never for what is encoded."""
    y, u, v = (p.astype(np.float32) for p in pixels.planes(raw, width, height))
    if full_range:
        y, u, v = (np.rint(16 + p * (s / 255)) for p, s in ((y, 219), (u, 224), (v, 224)))
    y = 1.164 * np.maximum(y - 16, 0)
    u, v = (np.repeat(np.repeat(p - 128, 2, 0), 2, 1) for p in (u, v))
    bgr = np.stack([y + 2.018 * u, y - 0.391 * u - 0.813 * v, y + 1.596 * v], axis=-1)
    return np.clip(np.rint(bgr), 0, 255).astype(np.uint8)


def packed(y: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Three planes as the one picture, half as high again, that converters take."""
    return np.concatenate([y.ravel(), u.ravel(), v.ravel()]).reshape(y.shape[0] * 3 // 2, y.shape[1])


def detect(frames: DataFrame, make_face: Callable[[], Detector], make_plate: Callable[[], Detector] | None, sweep: float, batch: int = 8, full_range: bool = False) -> DataFrame:
    """One row per attempted frame, with its detections above the sweep threshold (maybe none): faces first, then plates,
    each in the detector's order. frames: clip_id, frame_idx, width, height, raw. A batch is of one clip and size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = [d() for d in (make_face, make_plate) if d is not None]
        for pdf in batches:
            for (clip, w, h), part in pdf.groupby(["clip_id", "width", "height"], sort=False):
                for lo in range(0, len(part), batch):
                    some = part.iloc[lo : lo + batch]
                    idxs = [int(i) for i in some["frame_idx"]]
                    found: dict[int, list[tuple]] = {i: [] for i in idxs}
                    images = [image(raw, w, h, full_range) for raw in some["raw"]]
                    for d in asked:
                        for x in d.detect_batch(images, idxs):
                            if x.score > sweep:
                                found[x.frame_idx].append((x.cls, float(x.x1), float(x.y1), float(x.x2), float(x.y2), float(x.score)))
                    names = ("cls", "x1", "y1", "x2", "y2", "score")
                    yield pd.DataFrame({"clip_id": clip, "frame_idx": idxs, "detections": [[dict(zip(names, x)) for x in found[i]] for i in idxs]})

    return frames.select("clip_id", "frame_idx", "width", "height", "raw").mapInPandas(run, ATTEMPT)


def united(face: DataFrame, plate: DataFrame) -> DataFrame:
    """Detections of both detectors in one list a frame: faces first, each kind in its order. Columns: clip_id, frame_idx,
    det_seq and others; det_seq is numbered anew within the frame."""
    from pyspark.sql.window import Window

    both = face.withColumn("_kind", F.lit(0)).unionByName(plate.withColumn("_kind", F.lit(1)))
    w = Window.partitionBy("clip_id", "frame_idx").orderBy("_kind", "det_seq")
    return both.withColumn("det_seq", (F.row_number().over(w) - 1).cast("long")).drop("_kind")


def listed(attempts: DataFrame) -> DataFrame:
    """Attempted frames as detections with det_seq, their place in the frame."""
    d = attempts.select("clip_id", "frame_idx", F.posexplode("detections").alias("det_seq", "d"))
    return d.select("clip_id", "frame_idx", F.col("det_seq").cast("long").alias("det_seq"), "d.*")
