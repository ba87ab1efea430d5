"""Registered queries of the frame-track engine over the sample tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import actions, annolog, audit, detect, geom, hands, review, runs, tracks
from ..sources import documents, frames
from . import projections as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WIDTH = HEIGHT = 200
FPS = 30
RULES = tracks.TrackRules()
HYSTERESIS = tracks.TrackRules(keep=0.15)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def timed(spark: SparkSession, sf: str) -> DataFrame:
    return P.hand_frames(spark, sf).withColumn("timestamp_ms", F.col("frame_idx") * 66)


def face_and_plates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Detections, and static fill boxes: the dilated confident detections of each frame."""
    d = P.detections(spark, sf)
    return d, tracks.fill_boxes(tracks.operating(d, RULES), WIDTH, HEIGHT)


_FRAMES = f"with p as ({P.HAND_FRAMES})"
_DETS = f"with p as ({P.DETECTIONS})"
_LOG = f"with p as ({P.ANNOTATION_LOG}), cur as (select * from p qualify row_number() over (partition by video_id, unit_idx, stage, model_id order by write_seq desc) = 1)"
_OP = "case when cls = 'face' then 30e-2 else 40e-2 end"
_DILATED = (
    "d as (select *, (x1+x2)/2e0 as cx, (y1+y2)/2e0 as cy, ((x2-x1)*13e-1+16e0)/2e0 as hw, ((y2-y1)*13e-1+16e0)/2e0 as hh from p),"
    "fills as (select clip_id, frame_idx, cls, greatest(0e0, cx-hw) as x1, greatest(0e0, cy-hh) as y1, least(200e0, cx+hw) as x2, least(200e0, cy+hh) as y2 from d where score > " + _OP + ")"
)
#: Exact union coverage by coordinate compression: c has the candidates (id and box), r the clipped boxes.
_COVER = (
    "r as (select distinct c.clip_id, c.det_seq, greatest(f.x1,c.x1) as x1, greatest(f.y1,c.y1) as y1, least(f.x2,c.x2) as x2, least(f.y2,c.y2) as y2 from c join fills f on c.clip_id=f.clip_id and c.frame_idx=f.frame_idx where least(f.x2,c.x2)>greatest(f.x1,c.x1) and least(f.y2,c.y2)>greatest(f.y1,c.y1)),"
    "xs as (select clip_id, det_seq, x as xa, lead(x) over (partition by clip_id, det_seq order by x) as xb from (select clip_id, det_seq, x1 as x from r union select clip_id, det_seq, x2 from r)),"
    "ys as (select clip_id, det_seq, y as ya, lead(y) over (partition by clip_id, det_seq order by y) as yb from (select clip_id, det_seq, y1 as y from r union select clip_id, det_seq, y2 from r)),"
    "cells as (select distinct xs.clip_id, xs.det_seq, xa, xb, ya, yb from xs join ys on xs.clip_id=ys.clip_id and xs.det_seq=ys.det_seq join r on r.clip_id=xs.clip_id and r.det_seq=xs.det_seq and r.x1<=xa and r.x2>=xb and r.y1<=ya and r.y2>=yb),"
    "cov as (select clip_id, det_seq, sum((xb-xa)*(yb-ya)) as area from cells group by clip_id, det_seq),"
    "j as (select c.*, coalesce(cov.area,0e0)/((c.x2-c.x1)*(c.y2-c.y1)) as covered from c left join cov on c.clip_id=cov.clip_id and c.det_seq=cov.det_seq)"
)


@query("w1_gaps", _FRAMES + """, f as (select *, frame_idx * 66 as timestamp_ms, frame_idx - row_number() over (partition by video_id, hands_present = 0 order by frame_idx) as g from p)
select video_id, min(frame_idx) as start_frame, max(frame_idx) as end_frame, min(timestamp_ms) as start_ms, max(timestamp_ms) as end_ms, max(timestamp_ms) - min(timestamp_ms) as duration_ms, max(frame_idx) - min(frame_idx) + 1 as n_frames
from f where hands_present = 0 group by video_id, g""")
def w1_gaps(spark, sf):
    return runs.gaps(timed(spark, sf))


@query("w2_tiles", _FRAMES + """ select video_id, frame_idx // 8 as window_idx, array_to_string(list(frame_idx order by frame_idx), ',') as frames, count(*) < 8 as is_partial, min(frame_idx) * 750 as start_ms, (max(frame_idx) + 1) * 750 as end_ms from p group by 1, 2""")
def w2_tiles(spark, sf):
    t = runs.tiles(P.hand_frames(spark, sf))
    return t.withColumn("frames", F.array_join(F.col("frame_indices").cast("array<string>"), ",")).drop("frame_indices")


@query("a7_sampling", _FRAMES + """ select video_id, frame_idx as source_idx, frame_idx // 2 as frame_idx, cast(round_even(frame_idx / 30e0 * 1000, 0) as bigint) as timestamp_ms from p where frame_idx % 2 = 0""")
def a7_sampling(spark, sf):
    return runs.sample_frames(P.hand_frames(spark, sf).withColumnRenamed("frame_idx", "source_idx"), FPS).select("video_id", "source_idx", "frame_idx", "timestamp_ms")


@query("g1_presence", _FRAMES + " select video_id, count(*) as n_frames, count(*) filter (hands_present > 0) as n_with_hands from p group by 1")
def g1_presence(spark, sf):
    return runs.presence(P.hand_frames(spark, sf))


@query("b3_latest", _LOG + " select * from cur")
def b3_latest(spark, sf):
    return annolog.latest(P.annotation_log(spark, sf)).select("video_id", "unit_idx", "stage", "model_id", "error", "write_seq")


@query("f1_pending", _LOG + ", u as (select distinct video_id, unit_idx from p) select * from u where (video_id, unit_idx) not in (select (video_id, unit_idx) from cur where model_id = 'model-a' and stage = 'caption' and error is null)")
def f1_pending(spark, sf):
    log = P.annotation_log(spark, sf)
    return annolog.pending(log.select("video_id", "unit_idx").distinct(), log, "caption", "model-a")


@query("a9_point", _LOG + " select * from cur where video_id = 3 and unit_idx = 4 and stage = 'caption' and model_id = 'model-b'")
def a9_point(spark, sf):
    return annolog.point(P.annotation_log(spark, sf), 3, 4, "caption", "model-b").select("video_id", "unit_idx", "stage", "model_id", "error", "write_seq")


@query("a10_stage_scan", _LOG + " select video_id, unit_idx, model_id, error, write_seq from cur where stage = 'caption' order by 1, 2, 3")
def a10_stage_scan(spark, sf):
    return annolog.scan_stage(P.annotation_log(spark, sf), "caption").select("video_id", "unit_idx", "model_id", "error", "write_seq")


@query("k9_agreement", _LOG + " select a.video_id, a.unit_idx, a.stage, a.error as error_a, a.write_seq as seq_a, b.error as error_b, b.write_seq as seq_b, a.error is null and b.error is null as both_fine from cur a join cur b on a.video_id = b.video_id and a.unit_idx = b.unit_idx and a.stage = b.stage and a.model_id = 'model-a' and b.model_id = 'model-b'")
def k9_agreement(spark, sf):
    return annolog.agreement(P.annotation_log(spark, sf), "model-a", "model-b")


@query("c11_iou", _DETS.replace("with p as", "with p as materialized") + """, q as (select a.clip_id, a.det_seq, b.det_seq as other, least(a.x2,b.x2)-greatest(a.x1,b.x1) as w, least(a.y2,b.y2)-greatest(a.y1,b.y1) as h, (a.x2-a.x1)*(a.y2-a.y1)+(b.x2-b.x1)*(b.y2-b.y1) as s from p a join p b on a.clip_id=b.clip_id and a.frame_idx=b.frame_idx and a.det_seq<b.det_seq)
select clip_id, det_seq, other, round(case when w<=0 or h<=0 then 0e0 else w*h/(s-w*h) end, 9) as iou from q""")
def c11_iou(spark, sf):
    d = P.detections(spark, sf).select("clip_id", "frame_idx", "det_seq", geom.box("x1", "y1", "x2", "y2").alias("b"))
    o = d.select("clip_id", "frame_idx", F.col("det_seq").alias("other"), F.col("b").alias("o"))
    return d.join(o, ["clip_id", "frame_idx"]).where("det_seq < other").select("clip_id", "det_seq", "other", F.round(geom.iou(F.col("b"), F.col("o")), 9).alias("iou"))


@query("c12_coverage", _DETS + "," + _DILATED + ", c as (select * from p where score < " + _OP + ")," + _COVER + " select clip_id, det_seq, round(covered, 6) as covered from j")
def c12_coverage(spark, sf):
    d, fills = face_and_plates(spark, sf)
    per = fills.groupBy("clip_id", "frame_idx").agg(F.collect_list(geom.box("x1", "y1", "x2", "y2")).alias("boxes"))
    c = d.where(F.col("score") < audit.threshold(RULES.start)).withColumn("b", geom.box("x1", "y1", "x2", "y2")).join(per, ["clip_id", "frame_idx"], "left")
    return c.select("clip_id", "det_seq", F.round(geom.covered("b", "boxes"), 6).alias("covered"))


@query("c14_dilate", _DETS + "," + _DILATED + " select clip_id, frame_idx, cls, round(x1,6) as x1, round(y1,6) as y1, round(x2,6) as x2, round(y2,6) as y2 from fills")
def c14_dilate(spark, sf):
    return face_and_plates(spark, sf)[1].select("clip_id", "frame_idx", "cls", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("c19_regions", _DETS + "," + _DILATED + " select clip_id, frame_idx, cls, cast(floor(x1) as int) as lx1, cast(floor(y1) as int) as ly1, cast(ceil(x2) as int) as lx2, cast(ceil(y2) as int) as ly2, cast(floor(floor(x1)/2) as int) as cx1, cast(floor(floor(y1)/2) as int) as cy1, cast(ceil(ceil(x2)/2) as int) as cx2, cast(ceil(ceil(y2)/2) as int) as cy2 from fills")
def c19_regions(spark, sf):
    f = face_and_plates(spark, sf)[1].withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)})
    return geom.pixel_region(f).select("clip_id", "frame_idx", "cls", "lx1", "ly1", "lx2", "ly2", "cx1", "cy1", "cx2", "cy2")


@query("b12_crops", _DETS + ", s as (select *, greatest(greatest(x2-x1,y2-y1)*3e0,160e0) as side from p) select clip_id, det_seq, round(greatest(0e0,(x1+x2)/2-side/2),6) as crop_x1, round(greatest(0e0,(y1+y2)/2-side/2),6) as crop_y1, round(least(200e0,(x1+x2)/2+side/2),6) as crop_x2, round(least(200e0,(y1+y2)/2+side/2),6) as crop_y2 from s")
def b12_crops(spark, sf):
    d = geom.context_crop(P.detections(spark, sf).withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT)}))
    return d.select("clip_id", "det_seq", *[F.round(f"crop_{c}", 6).alias(f"crop_{c}") for c in ("x1", "y1", "x2", "y2")])


@query("f4_operating", _DETS + " select clip_id, det_seq, cls, score from p where score > " + _OP)
def f4_operating(spark, sf):
    return tracks.operating(P.detections(spark, sf), RULES).select("clip_id", "det_seq", "cls", "score")


@query("f4_at_threshold", _DETS + " select cls, count(*) as n from p where score = " + _OP + " group by 1")
def f4_at_threshold(spark, sf):
    """Rows exactly at their threshold: neither operating nor in the sweep band, so they are counted."""
    return P.detections(spark, sf).where(F.col("score") == audit.threshold(RULES.start)).groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


@query("f6_small", _DETS + " select clip_id, det_seq, x2-x1 < 70 or y2-y1 < 70 as small from p where score > " + _OP)
def f6_small(spark, sf):
    rules = tracks.TrackRules(min_box=70)
    kept, small = tracks.split_small(tracks.operating(P.detections(spark, sf), rules), rules)
    cols = ["clip_id", "det_seq"]
    return kept.select(*cols, F.lit(False).alias("small")).unionByName(small.select(*cols, F.lit(True).alias("small")))


@query("f5_sweep", _DETS + "," + _DILATED + ", c as (select * from p where score >= 10e-2 and score < " + _OP + ")," + _COVER + " select clip_id, frame_idx, det_seq, cls, score from j where covered < 98e-2")
def f5_sweep(spark, sf):
    return audit.sweep(*face_and_plates(spark, sf)).select("clip_id", "frame_idx", "det_seq", "cls", "score")


@query("t2_ranking", _DETS + "," + _DILATED + ", c as (select * from p where score >= 10e-2 and score < " + _OP + ")," + _COVER
       + ", k as (select *, row_number() over (partition by clip_id, cls order by score/(" + _OP + ") desc, det_seq) as nth from j where covered < 98e-2), t as (select *, row_number() over (partition by clip_id order by nth, cls='lp') as rank from k where nth <= 200) select clip_id, det_seq, cls, cast(rank as int) as rank from t where rank <= 200")
def t2_ranking(spark, sf):
    return audit.rank_findings(audit.sweep(*face_and_plates(spark, sf))).select("clip_id", "det_seq", "cls", "rank")


@query("g3_sweep_totals", _DETS + "," + _DILATED + ", c as (select * from p where score >= 10e-2 and score < " + _OP + ")," + _COVER
       + " select clip_id, count(*) as total, count(*) filter (cls='face') as n_face, count(*) filter (cls='lp') as n_lp, count(distinct frame_idx) as n_frames_hit, greatest(0, count(*)-200) as truncated from j where covered < 98e-2 group by 1")
def g3_sweep_totals(spark, sf):
    return audit.sweep_totals(audit.sweep(*face_and_plates(spark, sf)))


@query("f7_second_pass", _DETS + "," + _DILATED + ", c as (select * from p where score >= 20e-2 and frame_idx % 6 = 0)," + _COVER + " select clip_id, frame_idx, det_seq, score from j where covered < 98e-2")
def f7_second_pass(spark, sf):
    d, fills = face_and_plates(spark, sf)
    return audit.second_pass(d, fills, 6, 0.2).select("clip_id", "frame_idx", "det_seq", "score")


@query("w7_nms")
def w7_nms(spark, sf):
    return tracks.nms(P.detections(spark, sf)).select("clip_id", "frame_idx", "det_seq", "cls", "score")


@query("w4_tracks")
def w4_tracks(spark, sf):
    return tracks.build_tracks(P.detections(spark, sf), RULES)


@query("w4_hysteresis")
def w4_hysteresis(spark, sf):
    return tracks.build_tracks(P.detections(spark, sf), HYSTERESIS)


@query("w5_fill_boxes")
def w5_fill_boxes(spark, sf):
    dense = tracks.densify(tracks.build_tracks(P.detections(spark, sf), RULES), RULES)
    f = tracks.fill_boxes(dense, WIDTH, HEIGHT)
    return f.select("clip_id", "track_id", "cls", "frame_idx", "source", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


def clips(spark, sf):
    return P.clip_frames(spark, sf).withColumns({"width": F.lit(WIDTH), "height": F.lit(HEIGHT), "fps": F.lit(float(FPS))})


@query("g4_fill_stats", _DETS + "," + _DILATED + """, n as (select clip_id, max(frame_idx)+1 as n_frames from p group by 1), a as (select clip_id, frame_idx, sum((x2-x1)*(y2-y1)) as area from fills group by 1, 2), s as (select clip_id, count(*) as k, max(area) as m from a group by 1), f as (select clip_id, count(distinct frame_idx) as ff from fills where cls='face' group by 1)
select n.clip_id, n_frames, coalesce(k,0) as frames_with_fill, round(coalesce(k,0)/n_frames, 9) as fill_frac, round(coalesce(m,0e0)/40000, 9) as max_fill_area_frac, coalesce(ff,0) as face_frames from n left join s on n.clip_id=s.clip_id left join f on n.clip_id=f.clip_id""")
def g4_fill_stats(spark, sf):
    return tracks.fill_stats(face_and_plates(spark, sf)[1], clips(spark, sf).drop("fps"))


def audit_inputs(spark, sf):
    d, fills = face_and_plates(spark, sf)
    s = tracks.fill_stats(fills, clips(spark, sf).drop("fps"))
    m = audit.sweep(d, fills).groupBy("clip_id").agg(F.count(F.lit(1)).alias("sweep_misses"))
    c = F.col("clip_id")
    return s.join(m, "clip_id", "left").na.fill(0, ["sweep_misses"]).withColumns({
        "sweep_misses": F.when(c % 4 == 0, F.lit(0)).otherwise(F.col("sweep_misses")), "max_fill_area_frac": F.when(c % 4 == 0, F.lit(0.4)).otherwise(F.col("max_fill_area_frac")),
        "integrity_ran": c % 7 != 0, "checked": F.col("frames_with_fill"), "violations": F.when(c % 11 == 0, c % 5).otherwise(F.lit(0)), "yunet_ran": c % 3 != 0, "yunet_uncovered": F.when(c % 13 == 0, F.lit(2)).otherwise(F.lit(0)), "dropped_small": F.when(c % 17 == 0, F.lit(1)).otherwise(F.lit(0)),
    })


_AUDIT = ORACLES["g4_fill_stats"].replace("select n.clip_id, n_frames", ", st as (select n.clip_id, n_frames") + """), mi as (select clip_id, count(*) as sm from j where covered < 98e-2 group by 1),
i as (select st.*, case when st.clip_id%4=0 then 0 else coalesce(sm,0) end as sweep_misses, case when st.clip_id%4=0 then 4e-1 else max_fill_area_frac end as mf, st.clip_id%7<>0 as ran, case when st.clip_id%11=0 then st.clip_id%5 else 0 end as v, st.clip_id%3<>0 as yr, case when st.clip_id%13=0 then 2 else 0 end as yu, case when st.clip_id%17=0 then 1 else 0 end as ds from st left join mi on st.clip_id=mi.clip_id),
au as (select clip_id, list_filter([case when ran and v>0 then v||' fill integrity violations' end, case when sweep_misses>0 then sweep_misses||' uncovered weak detections' end, case when yr and yu>0 then yu||' uncovered faces of the second detector' end, case when not ran then 'fill integrity was not checked' end, case when mf>5e-1 then 'a frame is filled beyond the area limit' end, case when face_frames=0 and n_frames>0 then case when yr and yu=0 then 'no face was filled, and the second detector found none' else 'no face was filled, and nothing corroborates that' end end, case when ran and frames_with_fill=0 and frames_with_fill>0 then 'fills exist but none was checked' end, case when ds>0 then ds||' detections dropped as too small' end], lambda x: x is not null) as rs, yr from i),
o as (select clip_id, array_to_string(rs, '; ') as reasons, case when len(rs)>0 then 'NEEDS_REVIEW' when yr then 'PASS_AUTOMATED' else 'PASS_AUTOMATED_NO_YUNET' end as status from au)"""
_AUDIT = _AUDIT.replace(", n as (", ", c as (select * from p where score >= 10e-2 and score < " + _OP + ")," + _COVER + ", n as (", 1)


@query("g10_audit", _AUDIT + " select * from o")
def g10_audit(spark, sf):
    return audit.status(audit_inputs(spark, sf)).select("clip_id", F.array_join("reasons", "; ").alias("reasons"), "status")


@query("g11_run_summary", _AUDIT + " select count(*) filter (status like 'PASS%') as n_pass, count(*) filter (status='NEEDS_REVIEW') as n_needs_review, count(*) filter (status='FAILED') as n_failed from o")
def g11_run_summary(spark, sf):
    return audit.run_summary(audit.status(audit_inputs(spark, sf))).drop("failed_ids")


_FLAGS = _DETS + """, f as (select case when det_seq % 5 = 0 then 'yunet' else 'sweep' end as origin, * from p where score >= 10e-2 and score < 30e-2),
o as (select *, row_number() over (partition by clip_id order by origin <> 'yunet', score desc, det_seq) as pos from f)"""


def flag_rows(spark, sf):
    d = P.detections(spark, sf).where("score >= 0.1 and score < 0.3")
    return review.flags(d.where("det_seq % 5 <> 0"), d.where("det_seq % 5 = 0"))


@query("t1_flag_order", _FLAGS + " select clip_id, origin, det_seq, cast(pos as int) as pos from o where pos <= 200")
def t1_flag_order(spark, sf):
    return review.order_flags(flag_rows(spark, sf)).select("clip_id", "origin", "det_seq", "pos")


@query("g12_accounting", _FLAGS + " select clip_id, count(*) as collected, 0::bigint as malformed, clip_id % 5 as withheld, count(*) + clip_id % 5 as flagged, least(count(*), 100) as shown, count(*) + clip_id % 5 - least(count(*), 100) as truncated from f group by clip_id")
def g12_accounting(spark, sf):
    f = flag_rows(spark, sf)
    return review.accounting(f, f.select("clip_id", (F.col("clip_id") % 5).alias("withheld")).distinct(), 100)


@query("g9_cost", _DETS + ", n as (select clip_id, max(frame_idx)+1 as n from p group by 1), s as (select sum(ceil(n/3e0)) as sampled, sum(n) as frames from n) select cast(sampled as bigint) as sampled, cast(frames as bigint) as frames, round((sampled*(20e0/1000)+frames/40e0+frames/380e0+sampled*35e-3)/3600+5e-1, 6) as hours, round(round((sampled*(20e0/1000)+frames/40e0+frames/380e0+sampled*35e-3)/3600+5e-1, 6)*16e-2, 6) as usd from s")
def g9_cost(spark, sf):
    return audit.estimate_cost(clips(spark, sf), 20.0).withColumns({"sampled": F.col("sampled").cast("long"), "frames": F.col("frames").cast("long")})


@query("g8_probe", _DETS + " select cls, count(*) as n, count(*) filter (score > " + _OP + ") as n_above, max(score) as max_score from p group by cls")
def g8_probe(spark, sf):
    d = P.detections(spark, sf)
    return d.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") > audit.threshold(RULES.start)).alias("n_above"), F.coalesce(F.max("score"), F.lit(0.0)).alias("max_score"))


@query("t6_probe_frames", _DETS + ", n as (select clip_id, max(frame_idx)+1 as n from p group by 1), c as (select *, greatest(1, 40 // (select count(*) from n)) as per from n), w as (select *, least(per, greatest(1, n//3)) as want from c), s as (select *, greatest(3, n//want) as span from w), e as (select clip_id, want, unnest(range(0, n, span)) as frame_idx, span from s) select clip_id, frame_idx from e where frame_idx // span < want order by 1, 2 limit 40")
def t6_probe_frames(spark, sf):
    return audit.probe_frames(clips(spark, sf), 40)


@query("f3_floor", _DETS + " select clip_id, frame_idx, det_seq, cls, score from p where score > 10e-2 and cls = 'face'")
def f3_floor(spark, sf):
    return tracks.floor(P.detections(spark, sf), 0.1, ("face",)).select("clip_id", "frame_idx", "det_seq", "cls", "score")


@query("g7_low_frames")
def g7_low_frames(spark, sf):
    return tracks.low_frames(tracks.build_tracks(P.detections(spark, sf), tracks.hysteresis(RULES, 0.15)))


@query("u1_forced")
def u1_forced(spark, sf):
    d = P.detections(spark, sf).where("cls = 'face' and score >= 0.1 and score < 0.2").select("clip_id", "frame_idx", "x1", "y1", "x2", "y2")
    f = documents.forced_fills(d, clips(spark, sf), RULES, WIDTH, HEIGHT)
    return f.select("clip_id", "track_id", "frame_idx", "source", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("b7_manifest", _AUDIT + ", k as (select status, count(*) as n from o group by 1) select string_agg(status || '=' || n, ',' order by status) as clips_by_status, '' as failed_ids from k")
def b7_manifest(spark, sf):
    m = documents.run_manifest(audit.status(audit_inputs(spark, sf)))
    text = F.transform(F.map_entries("clips_by_status"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select(F.array_join(text, ",").alias("clips_by_status"), F.array_join(F.col("failed_ids").cast("array<string>"), ",").alias("failed_ids"))


@query("w3_hands")
def w3_hands(spark, sf):
    return hands.assign(P.hand_detections(spark, sf))


@query("j12_parse", f"with p as ({P.RESPONSES})" + """ select window_idx, variant not in (3,4,6) as schema_ok, 1 as n_actions, 0 as start_frame,
 cast(case when variant = 4 then n_frames else n_frames-1 end as int) as end_frame,
 case when variant = 3 then null else (with t(x) as (select regexp_extract(response_text, '"task_step": "([^"]*)"', 1)) select substring(trim(regexp_replace(lower(x), '[^a-z0-9]+', '_', 'g'), '_'), 1, 24) from t) end as task_step,
 case when variant in (3,6) then null else (case window_idx % 4 when 0 then 'grip' when 1 then 'pinch' when 2 then null else 'none' end) end as contact,
 case when variant in (3,6) then null else false end as right_visible, case when variant in (3,6) then null else 'independent' end as coordination from p""")
def j12_parse(spark, sf):
    p = actions.parse_responses(P.responses(spark, sf))
    a = F.col("actions")[0]
    return p.select("window_idx", "schema_ok", F.size("actions").alias("n_actions"), a["start_frame"].alias("start_frame"), a["end_frame"].alias("end_frame"), a["task_step"].alias("task_step"), a["left_hand"]["contact_type"].alias("contact"), a["right_hand"]["visible"].alias("right_visible"), a["coordination"].alias("coordination"))


@query("w9_boundaries", "with d as (select doc_id // 3 as window_idx, doc_id % 3 as pos, source as task_step, lang as video_id from documents), b as (select *, lag(task_step) over w as from_step, lag(window_idx) over w as bw from d window w as (partition by video_id order by window_idx, pos)) select video_id, window_idx, pos, from_step, task_step as to_step, case when bw = window_idx then 'intra_window' else 'window_seam' end as boundary_source from b where bw is not null")
def w9_boundaries(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return runs.boundaries(d.select(F.col("lang").alias("video_id"), F.floor(F.col("doc_id") / 3).alias("window_idx"), (F.col("doc_id") % 3).alias("pos"), F.col("source").alias("task_step")))


@query("j_scalars", r"""select doc_id, nullif(substring(regexp_replace(text, '^\s+|\s+$', '', 'g'), 1, 60), '') as clamped,
 (with s(x) as (select substring(trim(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '_'), 1, 24)) select case when regexp_full_match(x, '[a-z][a-z0-9_]{0,23}') then x end from s) as slug,
 'sha256:' || substring(sha256(text), 1, 16) as prompt_hash, case when doc_id % 4 = 0 then 'grip' when doc_id % 4 = 1 then 'none' end as contact from documents""")
def j_scalars(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    contact = F.element_at(F.array(F.lit(" GRIP "), F.lit("None"), F.lit("hover"), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return d.select("doc_id", S.clamp_text(F.col("text"), 60).alias("clamped"), S.slug(F.col("text")).alias("slug"), S.prompt_hash(F.col("text")).alias("prompt_hash"), S.vocab(contact, S.CONTACTS).alias("contact"))


@query("c_clock", _FRAMES + ", w as (select video_id, frame_idx // 8 as window_idx, count(*) as n, min(frame_idx) as a from p group by 1, 2) select video_id, window_idx, 'n=' || n || ' max=' || (n-1) || ' s=' || case n when 8 then '6' else regexp_replace(printf('%.2f', n*75e-2), '\\.?0+$', '') end as prompt, array_to_string(list_transform(range(0, n), lambda i: 'Frame ' || i), ',') as labels, printf('%02d:%05.2f', cast(floor(a/30e0/60) as int), a/30e0 - 60*floor(a/30e0/60)) as clock from w")
def c_clock(spark, sf):
    w = P.hand_frames(spark, sf).groupBy("video_id", F.floor(F.col("frame_idx") / 8).cast("long").alias("window_idx")).agg(F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("a"))
    t = F.lit("n={n_frames} max={max_frame_idx} s={window_seconds}")
    return w.select("video_id", "window_idx", S.render_prompt(t, F.col("n")).alias("prompt"), F.array_join(S.frame_labels(F.col("n").cast("int")), ",").alias("labels"), S.clock_text(F.col("a"), F.lit(30.0)).alias("clock"))


@query("c_rates", "select p_partkey, p_partkey % 61 as n, case when p_partkey % 7 = 0 then 0e0 else (p_partkey % 61) / cast(p_partkey % 7 as double) end as rate, cast(greatest(1, round_even((p_partkey % 61) / 10e0, 0)) as bigint) as stride, cast(round_even((p_partkey % 61) / 2e0, 0) as bigint) as hold from part")
def c_rates(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    n = F.col("p_partkey") % 61
    rate = S.rate_lenient(F.concat(n.cast("string"), F.lit("/"), (F.col("p_partkey") % 7).cast("string")))
    return p.select("p_partkey", n.alias("n"), rate.alias("rate"), S.stride(n, F.lit(10.0)).alias("stride"), S.holds(n / 2, F.lit(0), F.lit(0))[0].alias("hold"))


@query("c7_cost", "select l_orderkey, l_partkey, l_linenumber, l_quantity, sum(case when l_linenumber = 1 then null else (l_partkey * 3e-1 + l_suppkey * 12e-1) / 1e6 end) as usd from lineitem where l_orderkey % 50 = 0 group by all".replace("where l_orderkey % 50 = 0 ", ""))
def c7_cost(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    tokens = F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_partkey"))
    c = li.withColumn("usd", S.call_cost(tokens, F.col("l_suppkey"), F.lit(0.3), F.lit(1.2)))
    return c.groupBy("l_orderkey", "l_partkey", "l_linenumber", "l_quantity").agg(F.sum("usd").alias("usd"))


@query("a4_chapters", "select p_partkey, case when p_partkey % 3 = 0 then lpad(cast(p_partkey % 10000 as varchar), 4, '0') else p_name end as grp, case when p_partkey % 3 = 0 then p_partkey % 100 else 0 end as chapter from part")
def a4_chapters(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.format_string("GX%02d%04d", k % 100, k % 10000)).otherwise(F.col("p_name"))
    g, c = S.chapter(name)
    return p.select("p_partkey", g.alias("grp"), c.cast("long").alias("chapter"))


@query("u5_detections", _DETS + """ select clip_id, frame_idx, row_number() over (partition by clip_id, frame_idx order by cls = 'lp', det_seq) - 1 as det_seq, cls, score from p""")
def u5_detections(spark, sf):
    d = P.detections(spark, sf)
    both = detect.united(d.where("cls = 'face'"), d.where("cls = 'lp'"))
    return both.select("clip_id", "frame_idx", "det_seq", "cls", "score")


@query("b5_frames_to_do", _DETS + ", a as (select distinct clip_id, frame_idx from p where score >= 20e-2) select distinct clip_id, frame_idx from p where (clip_id, frame_idx) not in (select (clip_id, frame_idx) from a)")
def b5_frames_to_do(spark, sf):
    d = P.detections(spark, sf)
    return documents.frames_to_do(d.select("clip_id", "frame_idx").distinct(), d.where("score >= 0.2").select("clip_id", "frame_idx").distinct())


#: A frame's last whole number of thirds up to which an output of 4 frames in 3 seconds has its frames, at 30 frames a second.
_SLOT = "(({i}) * 8 + 90) // 180"


@query("a5_stills", _FRAMES + ", s as (select video_id, frame_idx as source_idx, " + _SLOT.format(i="frame_idx") + " as a, " + _SLOT.format(i="frame_idx + 1") + " as b from p) select video_id, source_idx, a as frame_idx from s where b > a")
def a5_stills(spark, sf):
    return frames.sample(P.hand_frames(spark, sf), (FPS, 1), (4, 3)).select("video_id", "source_idx", "frame_idx")


@query("b13_timelapse", _FRAMES + ", s as (select video_id, frame_idx as source_idx, (frame_idx * 2 + 30) // 60 as a, (frame_idx * 2 + 32) // 60 as b from p) select video_id, source_idx, a as frame_idx, a * 1000 // 15 as shown_ms from s where b > a")
def b13_timelapse(spark, sf):
    return frames.timelapse(P.hand_frames(spark, sf), (FPS, 1)).select("video_id", "source_idx", "frame_idx", "shown_ms")


@query("c18_range", "select p_partkey, cast(round_even(16e0 + (p_partkey % 256) * (219e0 / 255e0), 0) as int) as luma, cast(round_even(16e0 + (p_partkey % 256) * (224e0 / 255e0), 0) as int) as chroma from part")
def c18_range(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    luma, chroma = S.limited_range(F.col("p_partkey") % 256, F.col("p_partkey") % 256)
    return p.select("p_partkey", luma.alias("luma"), chroma.alias("chroma"))


@query("c9_landmarks", _DETS + " select clip_id, det_seq, 6 as n, cast(cast(x1 as float) as double) as wrist_x, cast(cast(y1 as float) as double) as wrist_y, cast(cast(x2 as float) as double) as last_x from p")
def c9_landmarks(spark, sf):
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(0.0).alias("z"))
    d = P.detections(spark, sf).withColumn("flat", S.flat_landmarks(F.array(point("x1", "y1"), point("x2", "y2"))))
    x, y = S.wrist(F.col("flat"))
    return d.select("clip_id", "det_seq", F.size("flat").alias("n"), x.cast("double").alias("wrist_x"), y.cast("double").alias("wrist_y"), F.get("flat", F.lit(3)).cast("double").alias("last_x"))
