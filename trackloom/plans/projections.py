"""Deterministic projections of the sample tables into the shapes of the engine, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "events lineitem documents part supplier".split()

HAND_FRAMES = """
select user_id as video_id,
       cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) as frame_idx,
       case event_type when 'error' then 0 when 'signup' then 0 when 'click' then 2 else 1 end as hands_present
from events"""

HAND_DETECTIONS = """
with f as (
  select user_id as video_id,
         cast(row_number() over (partition by user_id order by ts, event_id) - 1 as bigint) as frame_idx,
         case event_type when 'error' then 0 when 'signup' then 0 when 'click' then 2 else 1 end as n_det,
         cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
  from events),
d as (select 0 as det_seq union all select 1 as det_seq)
select video_id, frame_idx, det_seq,
       case when k % 17 = 0 then 1e0 - (25e-2 + 5e-1 * det_seq + 2e-2 * (k % 10))
            else 25e-2 + 5e-1 * det_seq + 2e-2 * (k % 10) end as x,
       5e-1 as y,
       case when k % 3 = 0 or det_seq = 1 then 'Right' else 'Left' end as label,
       cast(n_det as int) as n_det
from f cross join d"""

DETECTIONS = """
with o as (
  select l_suppkey, l_partkey, l_linenumber, l_quantity, l_discount, l_returnflag,
         cast(row_number() over (partition by l_suppkey
             order by l_shipdate, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice) - 1 as bigint) as rn
  from lineitem)
select l_suppkey as clip_id,
       cast(3 * floor(rn / 3e0) as bigint) as frame_idx,
       rn as det_seq,
       case when l_returnflag = 'N' then 'lp' else 'face' end as cls,
       round(l_discount * 5e0, 3) as score,
       (l_partkey % 4) * 30e0 as x1,
       (cast(l_quantity as int) % 4) * 30e0 as y1,
       (l_partkey % 4) * 30e0 + 60e0 + l_linenumber * 6e0 as x2,
       (cast(l_quantity as int) % 4) * 30e0 + 60e0 + l_linenumber * 6e0 as y2
from o"""

#: Frames of every clip of DETECTIONS: its greatest rn is the number of rows less one, so nothing is numbered for it.
CLIP_FRAMES = """
select l_suppkey as clip_id, cast(3 * floor((count(*) - 1) / 3e0) as bigint) + 1 as n_frames
from lineitem group by l_suppkey"""

ANNOTATION_LOG = """
select user_id as video_id,
       cast(regexp_extract(props, '([0-9]+)', 1) as int) % 10 as unit_idx,
       'caption' as stage,
       case when event_id % 2 = 0 then 'model-a' else 'model-b' end as model_id,
       case when event_type = 'error' then 'RuntimeError: simulated' end as error,
       event_id as write_seq
from events"""

RESPONSES = """
with b as (
  select doc_id as window_idx,
         case when doc_id % 5 = 0 then 3 else 8 end as n_frames,
         doc_id % 7 as variant,
         source || ' Step-' || cast(doc_id % 30 as string) || '!' as step,
         case doc_id % 4 when 0 then 'GRIP ' when 1 then 'pinch' when 2 then 'hover' else 'none' end as contact
  from documents),
a as (
  select *, '{"start_frame": 0, "end_frame": '
         || cast(case when variant = 4 then n_frames else n_frames - 1 end as string)
         || ', "task_step": "' || step || '", "left_hand": {"verb": "holding", "contact_type": "' || contact
         || '", "visible": true}, "right_hand": {"visible": true}, "coordination": "Independent"}' as act
  from b)
select window_idx, n_frames, variant,
       case variant
         when 0 then '{"actions": [' || act || ']}'
         when 1 then '```json' || chr(10) || '{"actions": [' || act || ']}' || chr(10) || '```'
         when 2 then '[' || act || ']'
         when 3 then '{"actions": []}'
         when 4 then '{"actions": [' || act || ']}'
         when 5 then '{"actions": [' || act || ',]}'
         else 'Here is "task_step": "' || step || '" and garbage' end as response_text
from a"""


def project(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A projection over the tables of a folder; table names bind to paths, so no catalog state is left behind."""
    import re

    for t in TABLES:
        sql = re.sub(rf"\bfrom {t}\b", f"from parquet.`{sf_dir}/{t}.parquet`", sql)
    return spark.sql(sql)


def hand_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, HAND_FRAMES)


def hand_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frames appear; of a frame with n_det detections the rows det_seq < n_det count."""
    return project(spark, sf_dir, HAND_DETECTIONS)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, DETECTIONS)


def clip_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, CLIP_FRAMES)


def annotation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, ANNOTATION_LOG)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(spark, sf_dir, RESPONSES)
