"""Left and right slots of hands over the frames of a video, with track ids.

The rule looks at the frame before, so it is a fold: frames of a video in order, one accumulator. It runs in the JVM as
`aggregate` over the ordered array of a video's frames; a video is the unit of state, and its length bounds the group.
The fold goes over chunks of CHUNK frames, each folded into an array of its own, so that what grows with the video is
copied once a chunk and not once a frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Farthest plausible move of a wrist between sampled frames.
MAX_DELTA = 0.25
CHUNK = 256

_POINT = "struct<x:double,y:double>"
_FRAMES = "array<struct<frame_idx:bigint,left_x:double,right_x:double,left_tid:int,right_tid:int>>"
_STATE = f"struct<pl:{_POINT},pr:{_POINT},lt:int,rt:int,nt:int,out:{_FRAMES}>"
_CARRY = f"struct<pl:{_POINT},pr:{_POINT},lt:int,rt:int,nt:int,outs:array<{_FRAMES}>>"


def _dist(a: str, b: str) -> str:
    return f"sqrt(({a}.x - {b}.x) * ({a}.x - {b}.x) + ({a}.y - {b}.y) * ({a}.y - {b}.y))"


def assign(dets: DataFrame, max_delta: float = MAX_DELTA) -> DataFrame:
    """dets: video_id, frame_idx, det_seq, x, y, label, n_det (rows det_seq >= n_det mark frames without that hand).
    One row per frame: left_x, right_x, left_track_id, right_track_id, hands_present."""
    real = F.when(F.col("det_seq") < F.col("n_det"), F.struct("det_seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "label"))
    frames = dets.groupBy("video_id", "frame_idx").agg(F.array_sort(F.collect_list(real)).alias("d"))
    seq = frames.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("frame_idx", "d"))).alias("f"))
    pt = lambda e: f"named_struct('x', {e}.x, 'y', {e}.y)"
    # 1. Which detection goes left (l) and which right (r).
    cost = lambda a, b: f"(coalesce({_dist('s.pl', a)}, 0D) + coalesce({_dist('s.pr', b)}, 0D))"
    both = "s.pl is not null and s.pr is not null"
    one_left = (
        f"case when {both} then {_dist('s.pl', 'q.d[0]')} <= {_dist('s.pr', 'q.d[0]')} "
        f"when s.pl is not null then {_dist('s.pl', 'q.d[0]')} <= {max_delta}D "
        f"when s.pr is not null then not ({_dist('s.pr', 'q.d[0]')} <= {max_delta}D) else q.d[0].label = 'Left' end"
    )
    first_left = (
        f"case when s.pl is not null or s.pr is not null then {cost('q.d[0]', 'q.d[1]')} <= {cost('q.d[1]', 'q.d[0]')} "
        "when q.d[0].label = 'Left' and q.d[1].label <> 'Left' then true when q.d[1].label = 'Left' and q.d[0].label <> 'Left' then false "
        "else q.d[0].x <= q.d[1].x end"
    )
    nothing = f"cast(null as {_POINT})"
    l = f"case size(q.d) when 0 then {nothing} when 1 then case when {one_left} then {pt('q.d[0]')} end else case when {first_left} then {pt('q.d[0]')} else {pt('q.d[1]')} end end"  # noqa: E741
    r = f"case size(q.d) when 0 then {nothing} when 1 then case when {one_left} then {nothing} else {pt('q.d[0]')} end else case when {first_left} then {pt('q.d[1]')} else {pt('q.d[0]')} end end"
    # 2. Whether the slot's id survives; with one hand it does, with two a jump drops it.
    keep_l = f"case when v.l is null then null when size(q.d) > 1 and s.pl is not null and {_dist('s.pl', 'v.l')} > {max_delta}D then null else s.lt end"
    keep_r = f"case when v.r is null then null when size(q.d) > 1 and s.pr is not null and {_dist('s.pr', 'v.r')} > {max_delta}D then null else s.rt end"
    step = (
        "element_at(transform(transform(transform(array(named_struct('l', L, 'r', R)), v -> named_struct('l', v.l, 'r', v.r, 'kl', KL, 'kr', KR)), "
        "v -> named_struct('l', v.l, 'r', v.r, 'lt', case when v.l is not null then coalesce(v.kl, s.nt) end, 'kr', v.kr, 'nt', s.nt + int(v.l is not null and v.kl is null))), "
        "v -> named_struct('pl', v.l, 'pr', v.r, 'lt', v.lt, 'rt', case when v.r is not null then coalesce(v.kr, v.nt) end, 'nt', v.nt + int(v.r is not null and v.kr is null), "
        "'out', concat(s.out, array(named_struct('frame_idx', q.frame_idx, 'left_x', v.l.x, 'right_x', v.r.x, 'left_tid', v.lt, 'right_tid', case when v.r is not null then coalesce(v.kr, v.nt) end))))), 1)"
    )
    step = step.replace("KL", keep_l).replace("KR", keep_r).replace("'l', L,", f"'l', {l},").replace("'r', R)", f"'r', {r})")
    chunks = f"transform(sequence(0, int((size(f) - 1) div {CHUNK})), i -> slice(f, i * {CHUNK} + 1, {CHUNK}))"
    zero = f"cast(named_struct('pl', null, 'pr', null, 'lt', null, 'rt', null, 'nt', 0, 'outs', array()) as {_CARRY})"
    begin = f"cast(named_struct('pl', g.pl, 'pr', g.pr, 'lt', g.lt, 'rt', g.rt, 'nt', g.nt, 'out', array()) as {_STATE})"
    chunk = f"aggregate(h, {begin}, (s, q) -> cast({step} as {_STATE}))"
    carry = f"element_at(transform(array({chunk}), e -> cast(named_struct('pl', e.pl, 'pr', e.pr, 'lt', e.lt, 'rt', e.rt, 'nt', e.nt, 'outs', concat(g.outs, array(e.out))) as {_CARRY})), 1)"
    out = seq.select("video_id", F.explode(F.expr(f"flatten(aggregate({chunks}, {zero}, (g, h) -> {carry}, g -> g.outs))")).alias("o"))
    return out.select(
        "video_id", "o.frame_idx", "o.left_x", "o.right_x", F.col("o.left_tid").alias("left_track_id"), F.col("o.right_tid").alias("right_track_id"),
        (F.col("o.left_x").isNotNull().cast("int") + F.col("o.right_x").isNotNull().cast("int")).alias("hands_present"),
    )
