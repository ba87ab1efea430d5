"""Media metadata, clip discovery and hand-track tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

HANDS_SCHEMA = (
    "video_id string, frame_idx long, timestamp_ms long, left_landmarks array<float>, right_landmarks array<float>, left_confidence float, "
    "right_confidence float, hands_present tinyint, detector_version string, left_track_id int, right_track_id int"
)
_PROBE = "struct<streams:array<struct<width:int,height:int,avg_frame_rate:string,r_frame_rate:string,nb_frames:string,duration:string,rotation:int,color_space:string,color_range:string>>,format:struct<duration:string>>"


def probe(raw: DataFrame) -> DataFrame:
    """raw: path, json (a media prober's output). Video facts; an unusable average rate is an error."""
    v = raw.withColumn("p", F.from_json("json", _PROBE)).withColumn("s", F.col("p.streams")[0])
    fps, real = S.rate_strict(F.col("s.avg_frame_rate")), S.rate_lenient(F.col("s.r_frame_rate"))
    dur = F.coalesce(F.col("s.duration").try_cast("double"), F.col("p.format.duration").try_cast("double"))
    v = v.select("path", fps.alias("fps"), real.alias("r_fps"), dur.alias("duration_sec"), "s.width", "s.height", F.col("s.nb_frames").try_cast("long").alias("nb"), F.coalesce("s.rotation", F.lit(0)).alias("rotation"), F.coalesce("s.color_space", F.lit("bt709")).alias("color_space"), F.coalesce("s.color_range", F.lit("tv")).alias("color_range"))
    return v.withColumn("n_frames", F.coalesce("nb", F.rint(F.col("duration_sec") * F.col("fps")).cast("long"))).withColumn("is_vfr", S.is_variable_rate(F.col("fps"), F.col("r_fps"))).drop("nb")


def clips(probed: DataFrame) -> DataFrame:
    """Clips of probed files: upright width and height, group and chapter; files whose rate varies are an error."""
    turned = F.col("rotation").isin(90, -90, 270, -270)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    group, chapter = S.chapter(stem)
    ok = S.is_constant_rate(F.col("fps"), F.col("r_fps"))
    c = probed.withColumn("fps", F.when(F.coalesce(ok, F.lit(False)), F.col("fps")).otherwise(F.raise_error(F.concat(F.lit("variable frame rate: "), "path")).cast("double")))
    c = c.withColumns({"w": F.when(turned, F.col("height")).otherwise(F.col("width")), "h": F.when(turned, F.col("width")).otherwise(F.col("height"))})
    return c.withColumns({"clip_id": stem, "name": name, "group": group, "chapter": chapter, "width": F.col("w"), "height": F.col("h")}).drop("w", "h")


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Video files under a folder, by path. No file, or a file name that occurs twice, is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    files = files.where(F.lower("path").rlike(r"\.(mp4|mov)$")).withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1))
    if files.isEmpty():
        raise FileNotFoundError(f"no video files under {folder}")
    twice = files.groupBy("name").count().where("count > 1").select("name").take(5)
    if twice:
        raise ValueError(f"file names that occur twice: {[r[0] for r in twice]}")
    return files.orderBy("path")


def read_hands(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HANDS_SCHEMA).parquet(path)


def write_hands(frames: DataFrame, path: str) -> None:
    """Writes the dense track (an empty one keeps its schema); gaps are a plan of their own over the same rows."""
    frames.select(*[c.strip().split()[0] for c in HANDS_SCHEMA.split(", ")]).write.mode("overwrite").option("compression", "zstd").parquet(path)
