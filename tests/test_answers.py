"""Answers that went wrong once, and operators held against plain loops."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from trackloom.operators import actions, audit, backends, guards, pixels, tracks
from trackloom.sources import documents

SF = "/root/testdata/sf0.001"


def test_no_text_stops_the_parser(spark):
    texts = [
        '{"actions": [{"start_frame": 99999999999, "end_frame": 3}]}',
        '{"actions": [{"start_frame": 0, "end_frame": 3, "task_step": "\\ud800"}]}',
        '{"actions": [{"start_frame": "' + "9" * 5000 + '", "end_frame": 3}]}',
        '{"actions": [{"start_frame": 1e400, "end_frame": 3}]}', "[" * 100_000, None, "", "{'a", '{"actions": [{"start_frame": -3000000000, "end_frame": 3}]}',
    ]
    d = spark.createDataFrame([(t, 8) for t in texts], "response_text string, n_frames int")
    rows = actions.parse_responses(d).collect()
    assert [r.schema_ok for r in rows] == [False] * len(texts) and all(r.actions[0].end_frame == 7 for r in rows)
    fine = actions.parse('{"score": NaN, "actions": [{"start_frame": 0, "end_frame": 3}]}', 8)
    assert fine[1] and fine[0][0][:2] == (0, 3)


def test_registry(tmp_path):
    p = tmp_path / "models.toml"
    p.write_text('[backend.openai-compat]\nbase_url = "http://default"\n[models.a]\nbackend = "openai-compat"\nmodel = "m"\nsupports_json_schema = true\nprovider_order = ["x"]\nimage_detail = "low"\ntokens_per_image_fn = "f"\n[models.b]\nbackend = "fake"\n')
    assert set(documents.load_registry(str(p))) == {"a", "b"}
    assert documents.model_entry(str(p), "a")["base_url"] == "http://default" and "base_url" not in documents.model_entry(str(p), "b")
    with pytest.raises(KeyError):
        documents.model_entry(str(p), "c")
    for bad in ('backend = "openai-compat"', 'model = "m"', 'backend = "fake"\nprice_in = 1.0'):
        p.write_text("[models.a]\n" + bad)
        with pytest.raises(ValueError):
            documents.load_registry(str(p))
    p.write_text('[models.a]\nbackend = "openai-compat"\nmodel = "m"')
    with pytest.raises(ValueError):
        documents.model_entry(str(p), "a")
    p.write_text("hello")
    assert documents.load_prompt(str(p))[1].startswith("sha256:2cf24dba5fb0a30e")


def test_fingerprint_holds_the_sweep():
    base = {"sweep_threshold": 0.1, "face_threshold": 0.3, "lp_threshold": 0.4, "continue_threshold": 0.0, "gen": "2"}
    same = documents.fingerprint(base | {"face_threshold": 0.5, "lp_threshold": 0.5, "continue_threshold": 0.2})
    assert same == documents.fingerprint(base) != documents.fingerprint(base | {"sweep_threshold": 0.05})


def test_integrity_checks_small_boxes():
    raw = bytes(range(64)) + bytes(32)
    assert pixels.integrity(raw, 8, 8, [(0, 0, 4, 4)]) == (1, 1, 0, 1)
    assert pixels.integrity(pixels.fill(raw, 8, 8, [(0, 0, 4, 4)]), 8, 8, [(0, 0, 4, 4), (2, 2, 2, 6)]) == (1, 0, 1, 1)


def test_short_decode_is_an_error(spark):
    frames = spark.createDataFrame([(1, f) for f in range(3)], "clip_id long, frame_idx long")
    clips = lambda n: spark.createDataFrame([(1, 3), (2, n)], "clip_id long, n_frames long")
    assert pixels.whole_clips(frames, clips(0)).count() == 2
    with pytest.raises(Exception, match="frames decoded of clip 2: 0 of 1"):
        pixels.whole_clips(frames, clips(1)).collect()


def test_zero_fill_is_corroborated_only_by_an_empty_second_pass(spark):
    rows = [(1, True, 0), (2, True, 3), (3, False, 0)]
    d = spark.createDataFrame(rows, "clip_id long, yunet_ran boolean, yunet_uncovered long").withColumns({
        "integrity_ran": F.lit(True), "checked": F.lit(0), "violations": F.lit(0), "sweep_misses": F.lit(0), "max_fill_area_frac": F.lit(0.0),
        "frames_with_fill": F.lit(0), "face_frames": F.lit(0), "n_frames": F.lit(9), "dropped_small": F.lit(0)})
    got = {r.clip_id: r.reasons for r in audit.status(d).collect()}
    assert got[1] == ["no face was filled, and the second detector found none"]
    assert got[2][-1] == got[3][-1] == "no face was filled, and nothing corroborates that"


def test_forced_boxes_reach_the_frames_between(spark):
    clips = spark.createDataFrame([(1, 100, 200, 200), (2, 9, 200, 200)], "clip_id long, n_frames long, width int, height int")
    make = lambda rows: spark.createDataFrame(rows, "clip_id long, frame_idx long, x1 double, y1 double, x2 double, y2 double")
    rules = tracks.TrackRules()
    got = documents.forced_fills(make([(1, 30, 60.0, 50.0, 50.0, 60.0), (1, 33, 51.0, 50.0, 61.0, 60.0), (3, 0, 1.0, 1.0, 2.0, 2.0)]), clips, rules, 200, 200)
    frames = {r.frame_idx for r in got.collect()}
    assert {30, 31, 32, 33} <= frames and max(frames) == 33 + rules.hold and {r[0] for r in got.select("clip_id").distinct().collect()} == {1}
    with pytest.raises(ValueError):
        documents.forced_fills(make([(2, 1, 300.0, 1.0, 310.0, 5.0)]), clips, rules, 200, 200)
    with pytest.raises(Exception, match="outside its clip"):
        documents.forced_fills(make([(2, 9, 1.0, 1.0, 10.0, 5.0)]), clips, rules, 200, 200).collect()


FINE = dict(dilate_scale=1.3, motion_margin=8, detect_hz=10.0, hold=15, back_hold=0, min_box=8, batch=4, resize=None, face_threshold=0.3, lp_threshold=0.4, sweep_threshold=0.1, continue_threshold=0.0, output_dir="/tmp/a/out", probe_dir=None)


@pytest.mark.parametrize("bad", [{"dilate_scale": 0.9}, {"motion_margin": -1}, {"detect_hz": 0}, {"hold": -1}, {"back_hold": -1}, {"min_box": -1}, {"batch": 0}, {"resize": 63}, {"face_threshold": 0.0}, {"lp_threshold": 1.1}, {"sweep_threshold": 0.3}, {"continue_threshold": 0.05}, {"continue_threshold": 0.3}, {"probe_dir": "/tmp/a/out/probe"}, {"probe_dir": "/tmp/a/out"}])
def test_guards(bad):
    assert guards.check(FINE)["probe_dir"] == "/tmp/a/out-probe" and guards.check(FINE | {"continue_threshold": 0.1, "resize": 64})
    with pytest.raises(ValueError, match=next(iter(bad))):
        guards.check(FINE | bad)
    assert tracks.hysteresis(tracks.TrackRules(), 0.0).keep is None and tracks.hysteresis(tracks.TrackRules(), 0.15).keep == 0.15


def test_waves_and_usage(spark):
    w = spark.createDataFrame([(v, i, 1, "p") for v in range(5) for i in range(7)], "video_id long, window_idx long, n_frames int, prompt string")
    ranked = sorted((r.video_id, r.window_idx, r._wave) for r in backends.ranked(w, 4).collect())
    assert [r[2] for r in ranked] == [k // 4 for k in range(35)]

    class Silent:
        def caption(self, images, prompt):
            return backends.Response("x")

    assert backends.in_waves(w.limit(2), Silent, lambda d: d.count(), 2, None, (1.0, 1.0)) == 0.0
    with pytest.raises(backends.Permanent):
        backends.in_waves(w.limit(2), Silent, lambda d: d.count(), 2, 5.0, (1.0, 1.0))


def test_retries():
    class Flaky:
        def __init__(self, errors):
            self.errors, self.calls = list(errors), 0

        def caption(self, images, prompt):
            self.calls += 1
            if self.errors:
                raise self.errors.pop(0)
            return "ok"

    slept = []
    ok = Flaky([backends.StatusError(500), TimeoutError()])
    assert backends.Retrying(ok, sleep=slept.append).caption([], "") == "ok" and slept == [1.0, 2.0]
    for errors, kind, calls in (([backends.StatusError(404)], backends.Permanent, 1), ([TimeoutError()] * 3, TimeoutError, 3), ([backends.SpendLimit()], backends.SpendLimit, 1)):
        f = Flaky(errors)
        with pytest.raises(kind):
            backends.Retrying(f, sleep=slept.append).caption([], "")
        assert f.calls == calls


def test_manifest_of_a_run_and_what_is_left(spark):
    a = spark.createDataFrame([(3, "FAILED"), (1, "FAILED"), (2, "PASS_AUTOMATED")], "clip_id long, status string")
    r = documents.run_manifest(a).first()
    assert r.clips_by_status == {"FAILED": 2, "PASS_AUTOMATED": 1} and r.failed_ids == [1, 3]
    m = spark.createDataFrame([(1, "h"), (2, "old"), (3, None)], "clip_id long, config_hash string")
    assert {r.clip_id for r in documents.clips_to_do(a, m, "h").collect()} == {2, 3}


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = w * h if w > 0 and h > 0 else 0.0
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter)


def test_suppression_against_a_loop(spark):
    from trackloom.plans import projections as P

    d = P.detections(spark, SF)
    groups = {}
    for r in d.collect():
        groups.setdefault((r.clip_id, r.frame_idx, r.cls), []).append(r)
    want = set()
    for rows in groups.values():
        kept = []
        for r in sorted(rows, key=lambda r: (-r.score, r.det_seq)):
            if all(overlap((r.x1, r.y1, r.x2, r.y2), k) <= 0.3 for k in kept):
                kept.append((r.x1, r.y1, r.x2, r.y2))
                want.add((r.clip_id, r.frame_idx, r.det_seq))
    assert {(r.clip_id, r.frame_idx, r.det_seq) for r in tracks.nms(d).collect()} == want


@pytest.mark.parametrize("name", ["c11_iou", "f3_floor", "f4_at_threshold", "b7_manifest", "g11_run_summary", "j_scalars"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "lineitem", "documents", "part"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want, got = con.sql(e.oracle_sql()[name]), e.queries()[name](spark, SF)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda rows: sorted((tuple(str(v).lower() for v in r) for r in rows))
    assert key(got.select(cols).collect()) == key(want.select(", ".join(cols)).fetchall())


def test_queries_without_sql_run(spark):
    assert e.queries()["u1_forced"](spark, SF).count() > 0
    g = e.queries()["g7_low_frames"](spark, SF).collect()
    assert all(r.det_low_frames == sorted(set(r.det_low_frames)) and r.n_low_absorbed >= len(r.det_low_frames) for r in g)


def test_http_backend(spark, monkeypatch):
    """A server on this machine: frames, prompt, key and usage arrive; a final status is fatal, others are asked again."""
    import base64
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen, codes = [], []

    class Server(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            code = codes.pop(0) if codes else 200
            self.send_response(code)
            self.end_headers()
            if code == 200:
                self.wfile.write(json.dumps({"choices": [{"message": {"content": "fine"}}], "usage": {"prompt_tokens": 7, "completion_tokens": 2}}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    entry = {"backend": "openai-compat", "model": "m", "base_url": f"http://127.0.0.1:{server.server_port}/v1", "image_detail": "low"}
    d = spark.createDataFrame([(1, 0, 2, "what?", [b"ab", b"c"])], "video_id long, window_idx long, n_frames int, prompt string, frames array<binary>")
    row = backends.call(d, backends.backend(entry, "NO_SUCH_KEY")).first()
    assert (row.response_text, row.tokens_in, row.tokens_out, row.error) == ("fine", 7, 2, None)
    content = seen[0][2]["messages"][0]["content"]
    assert seen[0][0] == "/v1/chat/completions" and content[0]["text"] == "what?" and content[1]["image_url"]["detail"] == "low"
    assert base64.b64decode(content[1]["image_url"]["url"].split(",")[1]) == b"ab" and len(content) == 3
    monkeypatch.setenv("A_KEY", "k")
    codes[:] = [500, 429]
    slept = []
    asking = backends.Retrying(backends.Http(entry, "A_KEY"), sleep=slept.append)
    assert asking.caption([b"x"], "p").text == "fine" and slept == [1.0, 2.0] and seen[-1][1] == "Bearer k"
    codes[:] = [401]
    with pytest.raises(backends.Permanent):
        asking.caption([b"x"], "p")
    with pytest.raises(backends.Permanent):
        backends.Http(entry | {"base_url": "https://example.invalid"}, "NO_SUCH_KEY").caption([], "p")
    server.shutdown()
    for bad in ({"base_url": "http://example.com"}, {"max_images": 4}, {"model": "<model>"}, {"backend": "other"}, {"backend": "fake"}):
        with pytest.raises(ValueError):
            backends.backend(entry | bad, "A_KEY")


def test_hands_like_a_plain_loop(spark):
    """Slots and ids of every frame of the small tables, against a loop over a video's frames."""
    from trackloom.operators import hands
    from trackloom.plans import projections as P

    d = P.hand_detections(spark, SF)
    frames = {}
    for r in d.collect():
        frames.setdefault((r.video_id, r.frame_idx), []).extend([(r.det_seq, float(r.x), float(r.y), r.label)] if r.det_seq < r.n_det else [])
    dist = lambda p, q: ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5
    want, video = {}, None
    for (v, f), found in sorted(frames.items()):
        if v != video:
            video, pl, pr, lt, rt, new = v, None, None, None, None, 0
        h = [((x, y), label) for _, x, y, label in sorted(found)]
        left = right = None
        if len(h) == 1:
            p = h[0][0]
            if pl and pr:
                is_left = dist(pl, p) <= dist(pr, p)
            elif pl or pr:
                is_left = dist(pl, p) <= hands.MAX_DELTA if pl else dist(pr, p) > hands.MAX_DELTA
            else:
                is_left = h[0][1] == "Left"
            left, right = (p, None) if is_left else (None, p)
        elif h:
            (a, la), (b, lb) = h[:2]
            cost = lambda x, y: (dist(pl, x) if pl else 0.0) + (dist(pr, y) if pr else 0.0)
            if pl or pr:
                straight = cost(a, b) <= cost(b, a)
            elif (la == "Left") != (lb == "Left"):
                straight = la == "Left"
            else:
                straight = a[0] <= b[0]
            left, right = (a, b) if straight else (b, a)
        keep_l = lt if left and not (len(h) > 1 and pl and dist(pl, left) > hands.MAX_DELTA) else None
        keep_r = rt if right and not (len(h) > 1 and pr and dist(pr, right) > hands.MAX_DELTA) else None
        lt = rt = None
        if left:
            lt, new = (keep_l, new) if keep_l is not None else (new, new + 1)
        if right:
            rt, new = (keep_r, new) if keep_r is not None else (new, new + 1)
        pl, pr = left, right
        want[v, f] = (left and left[0], right and right[0], lt, rt)
    got = {(r.video_id, r.frame_idx): (r.left_x, r.right_x, r.left_track_id, r.right_track_id) for r in hands.assign(d).collect()}
    assert got == want and len(got) > 100


def test_probe_dump_takes_the_best_and_an_even_spread(spark):
    frames = [(p, p % 3, 10 * p) for p in range(50)]
    fd = spark.createDataFrame(frames, "pos long, clip_id long, frame_idx long")
    for n, most in ((30, 20), (3, 20), (0, 7), (30, 1)):
        dets = [(p % 3, 10 * p, "lp" if p % 2 else "face", ((p * 37) % 50) / 50) for p in range(0, n)]
        dets += [(c, f, k, 0.01) for c, f, k, _ in dets]
        dd = spark.createDataFrame(dets, "clip_id long, frame_idx long, cls string, score double")
        best = {}
        for c, f, k, s in dets:
            best[f // 10] = max(best.get(f // 10, 0), s + (s > {"face": 0.30, "lp": 0.40}[k]))
        want = sorted(best, key=lambda p: (-best[p], p))[: most // 2]
        top = set(want)
        for p in range(0, 50, max(1, 50 // max(1, most - len(want)))):
            if len(want) < most and p not in want:
                want.append(p)
        got = audit.probe_dump(dd, fd, most).collect()
        assert [r.pos for r in got] == sorted(want) and {r.pos for r in got if r.by_score} == top


def test_clip_frames_number_no_rows(spark):
    from trackloom.plans import projections as P
    from trackloom.plans import registry

    got = registry.clips(spark, SF)
    want = P.detections(spark, SF).groupBy("clip_id").agg((F.max("frame_idx") + 1).alias("n_frames"))
    assert sorted(got.select("clip_id", "n_frames").collect()) == sorted(want.collect())
    assert got.select("clip_id", "n_frames").schema.simpleString() == want.schema.simpleString()
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_forced_boxes_read_their_tables_once_a_check(spark, tmp_path):
    """The query and its check each read the boxes and the clips once; a clip whose boxes are all empty is lost."""
    clips = spark.createDataFrame([(1, 100, 200, 200), (2, 9, 200, 200)], "clip_id long, n_frames long, width int, height int")
    boxes = spark.createDataFrame([(1, 3, 1.0, 1.0, 9.0, 9.0), (1, 3, 5.0, 5.0, 5.0, 9.0), (3, 3, 1.0, 1.0, 1.0, 1.0)], "clip_id long, frame_idx long, x1 double, y1 double, x2 double, y2 double")
    for d, name in ((clips, "clips"), (boxes, "boxes")):
        d.write.parquet(str(tmp_path / name))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    got = documents.forced_fills(read("boxes"), read("clips"), tracks.TrackRules(hold=1, back_hold=1), 200, 200)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert sorted(r.frame_idx for r in got.collect()) == [2, 3, 4]
    for empty in ((300.0, 1.0, 310.0, 9.0), (5.0, 1.0, 5.0, 9.0)):
        more = spark.createDataFrame([(2, 1, *empty)], boxes.schema)
        with pytest.raises(ValueError, match=r"\[2\]"):
            documents.forced_fills(boxes.unionByName(more), clips, tracks.TrackRules(), 200, 200)
