"""Tracks of detected boxes, the boxes between and around them, and the fill boxes made of them.

Matching boxes to tracks is greedy and sequential within a clip, so it is the one Python step; it reads sorted rows as a
stream and gives one row per matched detection. Interpolation, holds and dilation are set-based on top of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import geom


@dataclass(frozen=True)
class TrackRules:
    start: dict = field(default_factory=lambda: {"face": 0.30, "lp": 0.40})
    keep: float | None = None  # score above which a weaker box may continue a track; None: no hysteresis
    iou: float = 0.2
    low_iou: float = 0.5
    max_low_run: int = 4
    stride: int = 3
    hold: int = 30
    back_hold: int = 30
    min_box: float = 8.0


SCHEMA = "clip_id long, track_id int, cls string, frame_idx long, x1 double, y1 double, x2 double, y2 double, source string, seq int"
INPUT = ["clip_id", "frame_idx", "cls", "score", "x1", "y1", "x2", "y2"]


def match(dets: Iterable[tuple], rules: TrackRules, state: dict) -> list[tuple]:
    """Rows (track_id, cls, frame_idx, x1, y1, x2, y2, source, seq) of one clip's detections (frame_idx, cls, score, (x1, y1,
    x2, y2)), which come by frame and det_seq, a frame whole. state, of an earlier call or empty, is carried on."""
    reach, keep, low_reach = max(rules.hold, rules.back_hold, rules.stride), rules.keep, rules.max_low_run * rules.stride
    live: dict[str, list[dict]] = state.setdefault("live", {"face": [], "lp": []})
    rows: list[tuple] = []
    ids, before = state.get("ids", 0), state.get("rows", 0)
    for frame, group in groupby(dets, itemgetter(0)):
        boxes: dict[str, list[tuple]] = {}
        for d in group:
            if d[1] in boxes:
                boxes[d[1]].append(d)
            elif d[1] in live:
                boxes[d[1]] = [d]
        for cls in live:
            if cls not in boxes:
                continue
            start = rules.start[cls]
            free = boxes[cls] if keep is None else [d for d in boxes[cls] if d[2] > keep]
            tracks = live[cls] = [t for t in live[cls] if frame - t["last"] <= reach]
            for t in tracks:
                if not free:
                    break
                o = ax1, ay1, ax2, ay2 = t["box"]
                best, at = 0.0, -1
                for i, d in enumerate(free):  # intersection over union, written out as most of the time goes here
                    bx1, by1, bx2, by2 = d[3]
                    w = (bx2 if bx2 < ax2 else ax2) - (bx1 if bx1 > ax1 else ax1)
                    if w <= 0:
                        continue
                    h = (by2 if by2 < ay2 else ay2) - (by1 if by1 > ay1 else ay1)
                    if h <= 0:
                        continue
                    both = w * h
                    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - both
                    if union > 0 and both / union > best:
                        best, at = both / union, i
                if at < 0:
                    continue
                _, _, score, b = free[at]
                low = keep is not None and score <= start
                if best < (rules.low_iou if low else rules.iou):
                    continue
                if low:
                    if frame - t["sure"] > low_reach:
                        continue
                    b = (min(o[0], b[0]), min(o[1], b[1]), max(o[2], b[2]), max(o[3], b[3]))
                else:
                    t["sure"] = frame
                del free[at]
                t["box"], t["last"] = b, frame
                rows.append((t["id"], cls, frame, *b, "det_low" if low else "det", before + len(rows)))
            for _, _, score, b in free:
                if keep is None or score > start:
                    tracks.append({"id": ids, "box": b, "last": frame, "sure": frame})
                    rows.append((ids, cls, frame, *b, "det", before + len(rows)))
                    ids += 1
    state["ids"], state["rows"] = ids, before + len(rows)
    return rows


def match_clip(dets: pd.DataFrame, rules: TrackRules, state: dict | None = None) -> list[tuple]:
    """`match` of one clip's detections in det_seq order; the frames of a clip may come in several calls."""
    d = dets[dets["frame_idx"].notna()].sort_values("frame_idx", kind="stable")
    cols = [d[c].tolist() for c in INPUT[1:]]
    return match(zip(*cols[:3], zip(*cols[3:])), rules, {} if state is None else state)


def operating(dets: DataFrame, rules: TrackRules) -> DataFrame:
    """Detections that take part: above the class's threshold, or above the lower one with hysteresis."""
    if rules.keep is not None:
        return dets.where(F.col("score") > rules.keep)
    return dets.where(F.col("score") > F.when(F.col("cls") == "face", rules.start["face"]).otherwise(rules.start["lp"]))


def split_small(dets: DataFrame, rules: TrackRules) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped small). With hysteresis a small box counts as dropped only if it could have begun a track."""
    small = (F.col("x2") - F.col("x1") < rules.min_box) | (F.col("y2") - F.col("y1") < rules.min_box)
    op = F.when(F.col("cls") == "face", rules.start["face"]).otherwise(rules.start["lp"])
    seeds = F.lit(True) if rules.keep is None else F.col("score") > op
    return dets.where(~small), dets.where(small & seeds)


def _values(c: pa.Array) -> list:
    if pa.types.is_string(c.type) and len(c):  # few different ones: one object for each
        c = c.dictionary_encode()
        names = c.dictionary.to_pylist()
        return [None if i is None else names[i] for i in c.indices.to_pylist()] if c.null_count else [names[i] for i in _values(c.indices)]
    fast = not c.null_count and (pa.types.is_integer(c.type) or pa.types.is_floating(c.type))
    return c.to_numpy(zero_copy_only=False).tolist() if fast else c.to_pylist()


def match_sorted(rules: TrackRules):
    """Mapper from INPUT rows by clip, frame and det_seq to rows of SCHEMA. Of a clip only the live tracks are kept between
    batches, and of a frame that the next batch may go on with, its rows."""
    out = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[c.split()[1]]) for c in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        at: list = []

        def matched(clips: list, dets: list[tuple]) -> Iterator[pa.RecordBatch]:
            of, found, begin = [], [], 0
            for clip, group in groupby(clips):
                if at != [clip]:
                    at[:] = [clip]
                    state.clear()
                end = begin + len(list(group))
                rows = match(dets[begin:end], rules, state)
                of += [clip] * len(rows)
                found += rows
                begin = end
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([of, *zip(*found)], out.types)], schema=out)

        clips, dets = [], []
        for batch in batches:
            clip, frame, cls, score, *box = [_values(c) for c in batch.columns]
            clips += clip
            dets += zip(frame, cls, score, zip(*box))
            n = len(dets)
            while n and dets[n - 1][0] == dets[-1][0] and clips[n - 1] == clips[-1]:
                n -= 1
            yield from matched(clips[:n], dets[:n])
            clips, dets = clips[n:], dets[n:]
        yield from matched(clips, dets)

    return run


def build_tracks(dets: DataFrame, rules: TrackRules) -> DataFrame:
    """Matched detections of every clip."""
    kept, _ = split_small(operating(dets, rules), rules)
    order = ["clip_id", "frame_idx", F.col("det_seq").asc_nulls_last()]
    rows = kept.where("frame_idx is not null").select(*INPUT, "det_seq").repartition("clip_id").sortWithinPartitions(*order)
    return rows.select(*INPUT).mapInArrow(match_sorted(rules), SCHEMA)


def densify(tracks: DataFrame, rules: TrackRules) -> DataFrame:
    """Interpolated boxes between a track's real ones, and held boxes before the first and after the last. Each row gives
    the frames it stands for in one array, so what made the tracks runs once."""
    w = Window.partitionBy("clip_id", "track_id").orderBy("frame_idx")
    names = ["x1", "y1", "x2", "y2"]
    t = tracks.select("clip_id", "track_id", "cls", "frame_idx", *names, "source", F.lead("frame_idx").over(w).alias("nf"), F.lag("frame_idx").over(w).alias("pf"), *[F.lead(c).over(w).alias(f"n{c}") for c in names])
    f, nf, at = F.col("frame_idx"), F.col("nf"), F.col("at")
    none, step = F.array().cast("array<bigint>"), F.lit(1).cast("long")
    between = F.when(nf > f + 1, F.sequence(f + 1, nf - 1, step))
    after = F.when(nf.isNull() & F.lit(rules.hold > 0), F.sequence(f + 1, f + rules.hold, step))
    before = F.when(F.col("pf").isNull() & (f > 0) & F.lit(rules.back_hold > 0), F.sequence(F.greatest(F.lit(0), f - rules.back_hold), f - 1, step))
    t = t.withColumn("at", F.explode(F.concat(F.array(f), F.coalesce(between, after, none), F.coalesce(before, none))))
    mid, part = (at > f) & nf.isNotNull(), (at - f) / (nf - f)
    boxes = [F.when(mid, F.col(c) + (F.col(f"n{c}") - F.col(c)) * part).otherwise(F.col(c)).alias(c) for c in names]
    source = F.when(mid, F.lit("interp")).when(at != f, F.lit("hold")).otherwise(F.col("source"))
    return t.select("clip_id", "track_id", "cls", at.alias("frame_idx"), *boxes, source.alias("source"))


def floor(dets: DataFrame, sweep: float, classes: tuple[str, ...] = ("face", "lp")) -> DataFrame:
    """What a detector hands on: scores above the sweep threshold, of the classes asked for."""
    return dets.where((F.col("score") > sweep) & F.col("cls").isin(*classes))


def hysteresis(rules: TrackRules, keep: float | None) -> TrackRules:
    """Rules with or without hysteresis: a continue threshold of 0 or none means none, and tracking then sees only
    detections above the operating thresholds."""
    from dataclasses import replace

    return replace(rules, keep=keep or None)


def low_frames(tracks: DataFrame) -> DataFrame:
    """Per clip the frames, in order, of detections that only continued a track, and how many those detections are."""
    low = tracks.where("source = 'det_low'").groupBy("clip_id")
    return low.agg(F.array_sort(F.collect_set("frame_idx")).alias("det_low_frames"), F.count(F.lit(1)).alias("n_low_absorbed"))


def fill_boxes(dense: DataFrame, width: int, height: int) -> DataFrame:
    """Every track box of every frame, dilated and clipped."""
    return geom.dilate(dense.withColumns({"width": F.lit(width), "height": F.lit(height)})).drop("width", "height")


def fill_stats(fills: DataFrame, clips: DataFrame) -> DataFrame:
    """Per clip: frames with fill, their share, the largest sum of box areas in a frame, frames with a face fill.
    clips: clip_id, n_frames, width, height. Areas are summed, not united."""
    real = F.floor("x1") < F.ceil("x2")
    f = fills.where(real & (F.floor("y1") < F.ceil("y2"))).join(clips, "clip_id")
    per = f.where(F.col("frame_idx") < F.col("n_frames")).groupBy("clip_id", "frame_idx").agg(F.sum((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"))
    s = per.groupBy("clip_id").agg(F.count(F.lit(1)).alias("frames_with_fill"), F.max("area").alias("max_area"))
    face = fills.where("cls = 'face'").groupBy("clip_id").agg(F.countDistinct("frame_idx").alias("face_frames"))
    out = clips.join(s, "clip_id", "left").join(face, "clip_id", "left")
    n = F.coalesce("frames_with_fill", F.lit(0))
    return out.select("clip_id", "n_frames", n.alias("frames_with_fill"), F.round(n / F.col("n_frames"), 9).alias("fill_frac"), F.round(F.coalesce("max_area", F.lit(0.0)) / (F.col("width") * F.col("height")), 9).alias("max_fill_area_frac"), F.coalesce("face_frames", F.lit(0)).alias("face_frames"))


def nms(dets: DataFrame, iou: float = 0.3) -> DataFrame:
    """Greedy suppression per frame and class: by falling score, a box that overlaps a kept one by more than iou goes.
    A fold over the frame's boxes in the JVM; a frame's boxes are few."""
    cols = [c for c in dets.columns if c not in ("clip_id", "frame_idx", "cls")]
    item = F.struct((-F.col("score")).alias("_o"), F.col("det_seq").alias("_s"), *cols)
    g = dets.groupBy("clip_id", "frame_idx", "cls").agg(F.array_sort(F.collect_list(item)).alias("d"))
    none = F.filter("d", lambda _: F.lit(False))
    kept = F.aggregate("d", none, lambda acc, b: F.when(F.exists(acc, lambda k: geom.iou(b, k) > iou), acc).otherwise(F.concat(acc, F.array(b))))
    return g.select("clip_id", "frame_idx", "cls", F.explode(kept).alias("b")).select(*[F.col(c) if c in ("clip_id", "frame_idx", "cls") else F.col("b")[c].alias(c) for c in dets.columns])
