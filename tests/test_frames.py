"""Frames, detectors, isolated runs and the streaming forms of hands and tracks."""

import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.functions import scalars as S
from trackloom.operators import batch, detect, hands, pixels, tracks
from trackloom.plans import projections as P
from trackloom.sources import documents, frames
from trackloom.streaming import twins

SF = "/root/testdata/sf0.001"
CLIPS = "clip_id long, path string, width int, height int, n_frames long"


@pytest.fixture
def clips(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows, raws = [], {}
    for c, (w, h, n) in enumerate([(8, 6, 5), (4, 10, 3), (6, 6, 0)]):
        raws[c] = [rng.integers(0, 256, w * h * 3 // 2, dtype=np.uint8).tobytes() for _ in range(n)]
        path = str(tmp_path / f"{c}.yuv")
        with open(path, "wb") as f:
            f.write(b"".join(raws[c]))
        rows.append((c, path, w, h, n))
    return spark.createDataFrame(rows, CLIPS), raws


def copier(code):
    return [sys.executable, "-c", code]


@pytest.mark.parametrize("command", [None, [*copier("import sys; sys.stdout.buffer.write(open(sys.argv[1], 'rb').read())"), "{path}"]])
def test_decode(clips, command):
    d, raws = clips
    got = {(r.clip_id, r.frame_idx): bytes(r.raw) for r in frames.decode(d, command, 150).collect()}
    assert got == {(c, i): raw for c, rs in raws.items() for i, raw in enumerate(rs)}


def test_bad_decodes_are_errors(spark, clips):
    d, _ = clips
    fails = [copier("import sys; sys.exit(3)")]
    for bad, command in ((d.withColumn("n_frames", F.col("n_frames") + 1), None), (d.withColumn("width", F.lit(7)), None), (d.withColumn("width", F.lit(10)), None), (d.where("clip_id = 2"), fails[0])):
        with pytest.raises(Exception, match="decoded|even|bytes|ended with 3"):
            frames.decode(bad, command).collect()


@pytest.mark.parametrize("fps,rate", [((30, 1), (4, 3)), ((30000, 1001), (1, 1)), ((10, 1), (25, 1)), ((30, 1), (30, 1))])
def test_sampling_against_exact_fractions(spark, fps, rate):
    from fractions import Fraction
    from math import floor

    want, step = [], Fraction(fps[1], fps[0]) * Fraction(*rate)
    for i in range(100):
        want += [(i, k) for k in range(floor(i * step + Fraction(1, 2)), floor((i + 1) * step + Fraction(1, 2)))]
    d = spark.range(100).select(F.col("id").alias("frame_idx"))
    got = sorted((r.source_idx, r.frame_idx) for r in frames.sample(d, fps, rate).collect())
    assert got == want and [k for _, k in got] == list(range(len(got)))


def test_resize(clips):
    d, _ = clips
    rows = frames.resize(frames.decode(d), 4).collect()
    assert {(r.clip_id, r.width, r.height, len(r.raw)) for r in rows} == {(0, 4, 4, 24), (1, 2, 4, 12)}
    assert (frames.fitted(1920, 1080, 640), frames.fitted(1080, 1920, 640), frames.fitted(500, 500, 100)) == ((640, 360), (360, 640), (100, 100))
    p = np.full((6, 8), 77, np.uint8)
    assert (frames.scaled(p, 3, 5) == 77).all() and (frames.scaled(np.arange(48, dtype=np.uint8).reshape(6, 8), 8, 6) == np.arange(48).reshape(6, 8)).all()


@pytest.mark.parametrize("command", [None, [*copier("import sys; open(sys.argv[1], 'wb').write(sys.stdin.buffer.read())"), "{path}"]])
def test_encode_and_publish(spark, clips, tmp_path, command):
    d, raws = clips
    folder = str(tmp_path / "out")
    written = frames.encode(frames.decode(d), folder, "30", command).collect()
    assert sorted((r.clip_id, r.n_frames) for r in written) == [(0, 5), (1, 3)]
    assert sorted(os.listdir(folder)) == [f"{c}.mp4{frames.UNVERIFIED}" for c in (0, 1)]
    w = spark.createDataFrame(written)
    s = spark.createDataFrame([(0, "PASS_AUTOMATED")], "clip_id long, status string")
    for _ in range(2):  # a repeated task finds its work done
        assert {(r.clip_id, r.status) for r in frames.publish(w, s).collect()} == {(0, "PASS_AUTOMATED"), (1, "FAILED")}
    assert sorted(os.listdir(folder)) == ["0.mp4", f"1.mp4{frames.UNVERIFIED}"]
    assert open(folder + "/0.mp4", "rb").read() == b"".join(raws[0])


def test_digests(clips):
    d, raws = clips
    got = {r.path[-5:]: r.sha256 for r in frames.digests(d).collect()}
    assert got == {f"{c}.yuv": hashlib.sha256(b"".join(x)).hexdigest() for c, x in raws.items()}


def test_detect(spark, clips, tmp_path):
    class Corners:
        """Finds one box a frame, at its index, and one below the sweep threshold."""

        def __init__(self, cls):
            self.cls, self.sizes = cls, []

        def detect_batch(self, images, idxs):
            assert len(images) == len(idxs) <= 2 and all(i.shape[2] == 3 for i in images)
            return [detect.Detection(i, self.cls, i, 0, i + 1, 1, s) for i in reversed(idxs) for s in (0.9, 0.1) if i != 1]

    d, raws = clips
    a = detect.detect(frames.decode(d), lambda: Corners("face"), lambda: Corners("lp"), 0.1, batch=2)
    rows = {(r.clip_id, r.frame_idx): [(x.cls, x.x1, x.score) for x in r.detections] for r in a.collect()}
    assert rows == {(c, i): [] if i == 1 else [("face", i, 0.9), ("lp", i, 0.9)] for c in (0, 1) for i in range(len(raws[c]))}
    root = str(tmp_path / "attempts")
    documents.append_checkpoint(a.where("frame_idx < 2"), root, "f")
    documents.append_checkpoint(a.where("frame_idx = 0"), root, "f")
    documents.append_checkpoint(a, root, "g")
    done = documents.attempted(spark, root, "f")
    assert done.count() == 4 and documents.attempted(spark, root, "other").count() == 0
    todo = documents.frames_to_do(a, done)
    assert {(r.clip_id, r.frame_idx) for r in todo.collect()} == {(0, 2), (0, 3), (0, 4), (1, 2)}
    listed = [(r.frame_idx, r.det_seq, r.cls) for r in detect.listed(done.where("clip_id = 0")).collect()]
    assert sorted(listed) == [(0, 0, "face"), (0, 1, "lp")]
    one = detect.OneByOne(lambda image, i: [detect.Detection(i, "face", 0, 0, 1, 1, 0.5)])
    assert [x.frame_idx for x in one.detect_batch([None, None], [4, 7])] == [4, 7]


def test_choice_of_detector():
    both, old = {"1": "a", "2": "b"}, {"1": "a"}
    assert detect.choose("auto", both, {}) == ("2", "b", None)
    assert detect.choose("auto", old, {"1": "p", "2": "q"}) == ("1", "a", "p")
    assert detect.choose("1", both, {}) == ("1", "a", None)
    for g, face in (("2", old), ("auto", {}), ("3", both)):
        with pytest.raises(ValueError):
            detect.choose(g, face, {})


def test_images_keep_the_ends_of_the_range(spark):
    grey = lambda v, full: detect.image(bytes([v] * 4 + [128, 128]), 2, 2, full)[0, 0].tolist()
    assert [grey(v, True)[0] for v in (0, 255)] == [0, 255] and all(abs(grey(v, True)[1] - v) <= 1 for v in range(256))
    assert [grey(v, False)[0] for v in (0, 16, 235, 255)] == [0, 0, 255, 255]
    red = detect.image(bytes([81] * 4 + [90, 240]), 2, 2, False)[0, 0]
    assert red[2] > 250 and red[0] < 5 and red[1] < 5
    y, u, v = pixels.planes(bytes(range(24)), 4, 4)
    assert detect.packed(y, u, v).shape == (6, 4) and detect.packed(y, u, v).tobytes() == bytes(range(24))
    d = spark.range(256).select("id", *[c.alias(n) for c, n in zip(S.limited_range(F.col("id"), F.col("id")), ("y", "c"))])
    assert [(r.y, r.c) for r in d.collect()] == [(round(16 + i * (219 / 255)), round(16 + i * (224 / 255))) for i in range(256)]


def test_isolated(spark):
    def work(clip):
        if clip["clip_id"] == 1:
            raise OSError("no such clip")
        return "NEEDS_REVIEW" if clip["clip_id"] == 2 else "PASS_AUTOMATED"

    d = spark.range(4).select(F.col("id").alias("clip_id"))
    got = batch.isolated(d, work)
    assert [tuple(r) for r in got.orderBy("clip_id").collect()][:3] == [(0, "PASS_AUTOMATED", None), (1, "FAILED", "OSError: no such clip"), (2, "NEEDS_REVIEW", None)]
    assert batch.exit_code(got) == 1 and batch.exit_code(got.where("clip_id in (0, 3)")) == 0


def test_small_scalars(spark):
    r = spark.range(1).select(S.now_text().alias("t"), *[c.alias(n) for c, n in zip(S.wrist(S.flat_landmarks(F.array(*[F.struct(F.lit(i / 4).alias("x"), F.lit(i / 2).alias("y"), F.lit(0.0).alias("z")) for i in (1, 2)]))), "xy")]).first()
    assert len(r.t) == 20 and r.t[10] == "T" and r.t[-1] == "Z" and (r.x, r.y) == (0.25, 0.5)


def streamed(spark, rows, tmp_path, name, form, key):
    """Rows of a streaming form fed in three triggers, in order of the frames."""
    for k in range(3):
        rows.where(F.least(F.floor(key / 7), F.lit(2)) == k).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
    folder = tmp_path / "in"
    folder.mkdir()
    q = form(spark.readStream.schema(rows.schema).parquet(str(folder))).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        for k in range(3):
            for f in (tmp_path / f"in{k}").glob("part-*"):
                f.rename(folder / f"{k}-{f.name}")
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def same(a, b):
    cols = a.columns
    key = lambda d: sorted(map(str, d.select(cols).collect()))
    assert key(a) == key(b) and a.count() > 100


def test_hands_stream_equals_batch(spark, tmp_path):
    d = P.hand_detections(spark, SF)
    same(streamed(spark, d, tmp_path, "hands_out", twins.hands_stream, F.col("frame_idx")), hands.assign(d))


@pytest.mark.parametrize("keep", [None, 0.15])
def test_tracks_stream_equals_batch(spark, tmp_path, keep):
    rules = tracks.TrackRules(keep=keep)
    d = P.detections(spark, SF)
    name = "tracks_" + str(keep is None)
    same(streamed(spark, d, tmp_path, name, lambda s: twins.tracks_stream(s, rules), F.col("frame_idx") / 40), tracks.build_tracks(d, rules))


def test_hands_over_many_chunks(spark, monkeypatch):
    d = P.hand_detections(spark, SF)
    want = hands.assign(d)
    monkeypatch.setattr(hands, "CHUNK", 3)
    same(hands.assign(d), want)


def overlap(a, b):
    w, h = max(0.0, min(a[2], b[2]) - max(a[0], b[0])), max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)


def plain_tracks(rows, rules):
    """Tracks of one clip as lists of (frame, box, source), every track looking at a frame's boxes in order of birth."""
    found = []
    for frame in sorted({r.frame_idx for r in rows}):
        for cls in ("face", "lp"):
            op = rules.start[cls]
            boxes = {r.det_seq: r for r in rows if r.frame_idx == frame and r.cls == cls and r.score > (op if rules.keep is None else rules.keep)}
            boxes = {k: r for k, r in boxes.items() if min(r.x2 - r.x1, r.y2 - r.y1) >= rules.min_box}
            for t in [t for t in found if t["cls"] == cls and frame - t["at"][-1][0] <= max(rules.hold, rules.back_hold, rules.stride)]:
                old = t["at"][-1][1]
                fits = [(-overlap(old, (r.x1, r.y1, r.x2, r.y2)), k) for k, r in sorted(boxes.items())]
                v, k = min(fits, default=(0, None))
                if v == 0:
                    continue
                r, sure = boxes[k], boxes[k].score > op
                if -v < (rules.iou if sure else rules.low_iou):
                    continue
                if not sure and frame - t["sure"] > rules.max_low_run * rules.stride:
                    continue
                b = (r.x1, r.y1, r.x2, r.y2)
                t["at"].append((frame, b if sure else (*map(min, old[:2], b[:2]), *map(max, old[2:], b[2:])), "det" if sure else "det_low"))
                t["sure"] = frame if sure else t["sure"]
                del boxes[k]
            found += [{"cls": cls, "sure": frame, "at": [(frame, (r.x1, r.y1, r.x2, r.y2), "det")]} for _, r in sorted(boxes.items()) if r.score > op]
    return found


@pytest.mark.parametrize("keep", [None, 0.15])
def test_tracks_and_boxes_like_a_plain_loop(spark, keep):
    """Every track, and every box between and around its own, of the small tables."""
    rules = tracks.TrackRules(keep=keep, hold=4, back_hold=7)
    d = P.detections(spark, SF)
    by = {}
    for r in d.collect():
        by.setdefault(r.clip_id, []).append(r)
    want, dense = [], []
    for clip, rows in by.items():
        for i, t in enumerate(plain_tracks(rows, rules)):
            at = t["at"]
            want += [(clip, i, t["cls"], f, *b, s) for f, b, s in at]
            dense += [(clip, i, f, s, *b) for f, b, s in at]
            for (f, a, _), (g, b, _) in zip(at, at[1:]):
                dense += [(clip, i, k, "interp", *(x + (y - x) * (k - f) / (g - f) for x, y in zip(a, b))) for k in range(f + 1, g)]
            dense += [(clip, i, at[-1][0] + k, "hold", *at[-1][1]) for k in range(1, 5)]
            dense += [(clip, i, k, "hold", *at[0][1]) for k in range(max(0, at[0][0] - 7), at[0][0])]
    got = tracks.build_tracks(d, rules)
    rows = got.select("clip_id", "track_id", "cls", "frame_idx", "x1", "y1", "x2", "y2", "source").collect()
    assert sorted(map(tuple, rows)) == sorted(want) and len(want) > 500
    rows = tracks.densify(got, rules).select("clip_id", "track_id", "frame_idx", "source", "x1", "y1", "x2", "y2").collect()
    near = lambda x: [(*r[:4], *(round(v, 6) + 0.0 for v in r[4:])) for r in x]
    assert sorted(near(rows)) == sorted(near(dense))


def steps(df, *names):
    """How often each step stands in a plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [text.count(n) for n in names]


def test_boxes_between_run_the_matching_once(spark):
    d = P.detections(spark, SF)
    rules = tracks.TrackRules()
    dense = tracks.densify(tracks.build_tracks(d, rules), rules)
    assert steps(dense, "MapInArrow", "FlatMapGroupsInPandas", "FileScan parquet", "Union") == [1, 0, 1, 0]


def test_boxes_of_repeated_and_unknown_frames(spark):
    """A frame listed twice has no box between, a track's only row has boxes on both sides, a row without a frame stays."""
    rows = [(1, 0, "lp", 5, 0.0, 0.0, 9.0, 9.0, "det"), (1, 0, "lp", 5, 0.0, 0.0, 9.0, 9.0, "det"), (1, 1, "lp", 1, 2.0, 0.0, 9.0, 9.0, "det_low"), (2, 0, "face", None, 1.0, 1.0, 2.0, 2.0, "det")]
    t = spark.createDataFrame(rows, "clip_id long, track_id int, cls string, frame_idx long, x1 double, y1 double, x2 double, y2 double, source string")
    got = tracks.densify(t, tracks.TrackRules(hold=1, back_hold=2)).select("clip_id", "track_id", "frame_idx", "source", "x1").collect()
    key = lambda r: tuple(map(str, r))
    want = [(1, 0, 3, "hold", 0.0), (1, 0, 4, "hold", 0.0), (1, 0, 5, "det", 0.0), (1, 0, 5, "det", 0.0), (1, 0, 6, "hold", 0.0)]
    want += [(1, 1, 0, "hold", 2.0), (1, 1, 1, "det_low", 2.0), (1, 1, 2, "hold", 2.0), (2, 0, None, "det", 1.0)]
    assert sorted(map(key, got)) == sorted(map(key, want))


def matched_in_batches(spark, rules):
    """Batches that end anywhere, even within a frame, give the rows of whole clips; a clip without a number is one too."""
    import pandas as pd
    import pyarrow as pa

    d = P.detections(spark, SF).toPandas().sort_values(["clip_id", "frame_idx", "det_seq"])
    d = d[d["score"] > (rules.keep or 0.4)].astype({"clip_id": "Int64"})
    d.loc[d["clip_id"] == d["clip_id"].max(), "clip_id"] = pd.NA
    want = [(None if pd.isna(c) else c, *r) for c, g in d.groupby("clip_id", sort=False, dropna=False) for r in tracks.match_clip(g, rules)]
    table = pa.Table.from_pandas(d[tracks.INPUT], preserve_index=False)
    for size in (1, 2, 7, 1000, len(d)):
        got = [tuple(r.values()) for b in tracks.match_sorted(rules)(iter(table.to_batches(size))) for r in b.to_pylist()]
        assert got == want and len(got) > 300
    assert list(tracks.match_sorted(rules)(iter(table.slice(0, 0).to_batches()))) == []


def test_weak_boxes_over_batches(spark):
    matched_in_batches(spark, tracks.TrackRules(keep=0.15))


def test_tracks_over_batches(spark):
    rules = tracks.TrackRules()
    matched_in_batches(spark, rules)
    assert steps(tracks.build_tracks(P.detections(spark, SF), rules), "MapInArrow", "FlatMapGroupsInPandas", "FileScan parquet") == [1, 0, 1]


def test_low_frames_of_one_matching(spark):
    rules = tracks.hysteresis(tracks.TrackRules(), 0.15)
    d = P.detections(spark, SF)
    want = {}
    for clip, g in d.where("score > 0.15").toPandas().sort_values("det_seq").groupby("clip_id"):
        low = [r[2] for r in tracks.match_clip(g, rules) if r[7] == "det_low"]
        want |= {clip: (sorted(set(low)), len(low))} if low else {}
    got = tracks.low_frames(tracks.build_tracks(d, rules))
    assert steps(got, "MapInArrow", "FlatMapGroupsInPandas", "FileScan parquet") == [1, 0, 1]
    assert {r.clip_id: (r.det_low_frames, r.n_low_absorbed) for r in got.collect()} == want and want


def test_columns_of_a_batch_as_values():
    """A class is one object however often it stands in a batch; nulls, slices and empty columns keep their values."""
    import pyarrow as pa

    lists = [["face", "lp", None, "face"], ["lp"] * 5, [], [None, None], [1, None, 3], [1, 2], [0.5, None], [0.1, 0.2]]
    cols = [pa.array(x, t) for x, t in zip(lists, [pa.string()] * 4 + [pa.int64()] * 2 + [pa.float64()] * 2)]
    assert [tracks._values(c) for c in cols] == lists and [tracks._values(c.slice(1)) for c in cols] == [x[1:] for x in lists]
    assert len(set(map(id, tracks._values(pa.array(["face long", "lp long"] * 50))))) == 2
    assert [type(v) for v in tracks._values(cols[5]) + tracks._values(cols[7])] == [int, int, float, float]
