"""The frame-track engine on small frames, against the rules and against plain Python."""

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackloom.functions import scalars as S
from trackloom.operators import actions, annolog, audit, backends, geom, pixels, review, runs, tracks
from trackloom.sources import documents, media
from trackloom.streaming import twins


def frames(spark, present, video=1):
    return spark.createDataFrame([(video, i, i * 66, p) for i, p in enumerate(present)], "video_id long, frame_idx long, timestamp_ms long, hands_present int")


def test_gaps_of_runs_and_tail(spark):
    got = sorted((r.start_frame, r.end_frame, r.n_frames, r.duration_ms) for r in runs.gaps(frames(spark, [1, 1, 0, 0, 0, 1, 0, 2])).collect())
    assert got == [(2, 4, 3, 132), (6, 6, 1, 0)]
    assert [(r.start_frame, r.end_frame) for r in runs.gaps(frames(spark, [1, 0, 0])).collect()] == [(1, 2)]
    assert runs.gaps(frames(spark, [i % 2 for i in range(50)])).count() == 25


def test_gaps_stream_equals_batch(spark, tmp_path):
    src = frames(spark, [1, 0, 0, 1, 0, 0, 2, 0]).unionByName(spark.createDataFrame([(1, None, None, 0)], "video_id long, frame_idx long, timestamp_ms long, hands_present int"))
    src.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = twins.gaps_stream(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("gaps_out").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    cols = ["start_frame", "end_frame", "n_frames"]
    assert sorted(map(tuple, spark.table("gaps_out").select(cols).collect())) == sorted(map(tuple, runs.gaps(src.where("frame_idx is not null")).select(cols).collect()))


@pytest.mark.parametrize("n,windows,partial", [(20, 3, 1), (16, 2, 0), (0, 0, 0)])
def test_tiles(spark, n, windows, partial):
    got = runs.tiles(frames(spark, [1] * n)).collect()
    assert (len(got), sum(r.is_partial for r in got)) == (windows, partial)
    assert all(r.start_ms == 6000 * r.window_idx for r in got)


def test_latest_write_wins_and_resume(spark):
    log = spark.createDataFrame([("v", 5, "caption", "m", "err", 1), ("v", 5, "caption", "m", None, 2), ("v", 6, "caption", "m", None, 1), ("v", 6, "caption", "m", "err", 3)], "video_id string, unit_idx int, stage string, model_id string, error string, write_seq long")
    assert [r.unit_idx for r in annolog.done(log, "caption", "m").collect()] == [5]
    units = spark.createDataFrame([("v", i) for i in (5, 6, 7)], "video_id string, unit_idx int")
    assert sorted(r.unit_idx for r in annolog.pending(units, log, "caption", "m").collect()) == [6, 7]


def test_coverage_against_a_raster(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        b = lambda: (x := rnd.randrange(0, 18), y := rnd.randrange(0, 18), x + rnd.randrange(1, 9), y + rnd.randrange(1, 9))
        rows.append((i, tuple(map(float, b())), [tuple(map(float, b())) for _ in range(rnd.randrange(0, 6))]))
    d = spark.createDataFrame(rows, f"i int, b {geom.BOX}, boxes array<{geom.BOX}>")
    got = {r.i: r.c for r in d.select("i", geom.covered("b", "boxes").alias("c")).collect()}
    for i, b, boxes in rows:
        cells = [(x, y) for x in range(int(b[0]), int(b[2])) for y in range(int(b[1]), int(b[3]))]
        hit = sum(any(q[0] <= x < q[2] and q[1] <= y < q[3] for q in boxes) for x, y in cells)
        assert got[i] == pytest.approx(hit / len(cells))


def test_dilate(spark):
    d = spark.createDataFrame([(100.0, 100.0, 200.0, 200.0, 1000, 1000)], "x1 double, y1 double, x2 double, y2 double, width int, height int")
    assert tuple(geom.dilate(d).first())[:4] == (77.0, 77.0, 223.0, 223.0)


def dets(rows):
    return pd.DataFrame([(f, i, c, *b, s) for i, (f, c, b, s) in enumerate(rows)], columns=["frame_idx", "det_seq", "cls", "x1", "y1", "x2", "y2", "score"])


BOX = (100.0, 100.0, 200.0, 200.0)


def test_tracks_hysteresis_and_drift():
    hyst = tracks.TrackRules(keep=0.15)
    assert tracks.match_clip(dets([(0, "face", BOX, 0.18)]), hyst) == []
    assert [r[7] for r in tracks.match_clip(dets([(0, "face", BOX, 0.9), (3, "face", BOX, 0.18)]), hyst)] == ["det", "det_low"]
    run = [(0, "face", BOX, 0.9)] + [(3 * k, "face", BOX, 0.18) for k in range(1, 9)]
    assert sum(r[7] == "det_low" for r in tracks.match_clip(dets(run), hyst)) == 4


def test_tracks_stride_floor():
    two = [(0, "face", BOX, 0.9), (10, "face", BOX, 0.9)]
    n = lambda stride: len({r[0] for r in tracks.match_clip(dets(two), tracks.TrackRules(stride=stride, hold=2, back_hold=2))})
    assert (n(10), n(1)) == (1, 2)


def test_densify_interpolates_and_holds(spark):
    t = spark.createDataFrame([(1, 0, "face", 0, 0.0, 0.0, 10.0, 10.0, "det"), (1, 0, "face", 3, 6.0, 0.0, 16.0, 10.0, "det")], "clip_id long, track_id int, cls string, frame_idx long, x1 double, y1 double, x2 double, y2 double, source string")
    got = {r.frame_idx: (r.x1, r.source) for r in tracks.densify(t, tracks.TrackRules(hold=2, back_hold=2)).collect()}
    assert got == {0: (0.0, "det"), 1: (2.0, "interp"), 2: (4.0, "interp"), 3: (6.0, "det"), 4: (6.0, "hold"), 5: (6.0, "hold")}


def test_ranking_gives_faces_their_turn(spark):
    rows = [(1, i, "lp", 0.39) for i in range(400)] + [(1, 400 + i, "face", 0.29) for i in range(5)]
    top = audit.rank_findings(spark.createDataFrame(rows, "clip_id long, det_seq long, cls string, score double"))
    assert top.count() == 200 and top.where("cls = 'face'").count() == 5


def test_audit_status(spark):
    base = dict(clip_id=1, integrity_ran=True, checked=5, violations=0, sweep_misses=0, yunet_ran=True, yunet_uncovered=0, max_fill_area_frac=0.5, frames_with_fill=5, face_frames=5, n_frames=10, dropped_small=0)
    rows = [base, base | {"max_fill_area_frac": 0.501}, base | {"yunet_ran": False}, base | {"face_frames": None, "frames_with_fill": 0}, base | {"integrity_ran": False}]
    d = spark.createDataFrame([tuple(r.values()) for r in rows], "clip_id long, integrity_ran boolean, checked long, violations long, sweep_misses long, yunet_ran boolean, yunet_uncovered long, max_fill_area_frac double, frames_with_fill long, face_frames long, n_frames long, dropped_small long")
    assert [r.status for r in audit.status(d).collect()] == ["PASS_AUTOMATED", "NEEDS_REVIEW", "PASS_AUTOMATED_NO_YUNET", "NEEDS_REVIEW", "NEEDS_REVIEW"]


def test_flag_accounting(spark):
    f = spark.createDataFrame([("c", "sweep", False)] * 200, "clip_id string, origin string, malformed boolean")
    r = review.accounting(f, spark.createDataFrame([("c", 5300)], "clip_id string, withheld long"), 200).first()
    assert (r.flagged, r.shown, r.truncated) == (5500, 200, 5300)


GOOD = {"start_frame": "0", "end_frame": 7.0, "task_step": "Pluck Leaves!", "left_hand": {"verb": "hold", "contact_type": "GRIP ", "visible": "yes"}, "right_hand": {"visible": True}, "coordination": "Independent"}


def test_parse_ladder():
    acts, ok = actions.parse(json.dumps({"actions": [GOOD]}), 8)
    assert ok and acts[0][:3] == (0, 7, "pluck_leaves") and acts[0][3][3] == "grip" and acts[0][4] == (None, None, None, None, False)
    fenced = "```json\n" + json.dumps([GOOD]) + "\n```"
    assert actions.parse(fenced, 8)[1]
    assert actions.parse(json.dumps([GOOD])[:-2] + ",}]", 8)[1]
    acts, ok = actions.parse(json.dumps([GOOD]), 3)
    assert not ok and acts[0][1] == 7
    for bad in ("[]", '{"actions": []}', "nonsense", "", None, json.dumps([GOOD | {"end_frame": 4.5}]), json.dumps([GOOD | {"left_hand": None}])):
        acts, ok = actions.parse(bad, 8)
        assert not ok and len(acts) == 1 and acts[0][:2] == (0, 7)
    assert actions.parse("x" + " " * 200_000 + "```", 8)[1] is False


def test_scalars(spark):
    d = spark.createDataFrame([("```json\n[1]\n```", " A-b C! ", "30000/1001"), ("x", "9lives", "5/0")], "a string, b string, c string")
    got = d.select(S.strip_fence(F.col("a")), S.slug(F.col("b")), S.rate_lenient(F.col("c"))).collect()
    assert got[0][0] == "[1]" and got[0][1] == "a_b_c" and got[0][2] == pytest.approx(29.97, abs=1e-3)
    assert tuple(got[1]) == ("x", None, 0.0)


def test_sources(spark, tmp_path):
    clips = spark.createDataFrame([("c", 10, 64, 64)], "clip_id string, n_frames long, width int, height int")
    forced = spark.createDataFrame([("c", 2, 30.0, 5.0, 10.0, 90.0), ("other", 1, 0.0, 0.0, 1.0, 1.0)], "clip_id string, frame_idx long, x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r)[2:] for r in documents.forced_boxes(forced, clips).collect()] == [(10.0, 5.0, 30.0, 64.0)]
    lines = [("c", 0, '{"fingerprint": "f"}'), ("c", 1, '{"frame_idx": 0, "detections": []}'), ("c", 2, '{"frame_i')]
    d = spark.createDataFrame(lines, "clip_id string, line_no int, value string")
    assert [r.frame_idx for r in documents.read_checkpoint(d, "f").collect()] == [0]
    assert documents.read_checkpoint(d, "other").count() == 0
    w = spark.range(3).withColumnRenamed("id", "window_idx")
    assert [r.response_text for r in documents.replay(w, ['{"response_text": "a"}', "", '{"response_text": "b"}']).orderBy("window_idx").collect()] == ["a", "b", "a"]
    documents.write_shard(w, str(tmp_path / "s"), "r", "gpu", "detect", 1)
    assert documents.read_shard(spark, str(tmp_path / "s"), 1).count() == 3
    p = spark.createDataFrame([("/v/GX010042.MP4", json.dumps({"streams": [{"width": 640, "height": 360, "avg_frame_rate": "30/1", "r_frame_rate": "30/1", "duration": "18.0", "rotation": 90}]}))], "path string, json string")
    c = media.clips(media.probe(p)).first()
    assert (c.n_frames, c.group, c.chapter, c.width, c.height, c.is_vfr) == (540, "0042", 1, 360, 640, False)


def test_backend_rows(spark):
    w = spark.createDataFrame([(1, i, 8, "p") for i in range(3)], "video_id long, window_idx long, n_frames int, prompt string")
    seen = []
    spent = backends.in_waves(w, lambda: backends.Replay(["a", "b"]), lambda d: (seen.append(d.count()), d)[1], 2, None, (1.0, 1.0))
    assert seen == [2, 1] and spent == pytest.approx(27 / 1e6)


def test_pixels():
    raw = bytes(range(64)) + bytes(16) + bytes(16)
    done = pixels.fill(raw, 8, 8, [(0.5, 0.5, 7.2, 7.2)])
    assert set(pixels.planes(done, 8, 8)[0].ravel().tolist()) == {128}
    assert pixels.integrity(done, 8, 8, [(0, 0, 8, 8)]) == (1, 0, 0, 1)
    assert pixels.integrity(raw, 8, 8, [(0, 0, 8, 8)])[1] == 1
