"""Documents of a run: shards, checkpoints, manifests, forced boxes, registries, replayed responses."""

from __future__ import annotations

import json
import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONTRACT_VERSION = 1
# Fixed values of the model registry.
MODEL_KEYS = {
    "backend", "base_url", "image_detail", "max_images", "model", "price_in_per_mtok", "price_out_per_mtok", "provider_order",
    "supports_json_schema", "tokens_per_image_fn",
}
REQUIRED_KEYS = {"backend"}
HTTP_BACKEND = "openai-compat"
#: Settings applied to stored detections afterwards; all others belong to a detection pass.
AFTERWARDS = {"face_threshold", "lp_threshold", "continue_threshold"}


def write_shard(rows: DataFrame, root: str, run_id: str, pod_role: str, stage: str, shard_index: int) -> None:
    """Appends an immutable shard; its place is unique, so writers need no lock."""
    cols = {"contract_version": F.lit(CONTRACT_VERSION), "run_id": F.lit(run_id), "pod_role": F.lit(pod_role), "stage": F.lit(stage), "shard_index": F.lit(shard_index)}
    rows.withColumns(cols).write.mode("append").partitionBy("run_id", "pod_role", "stage", "shard_index").parquet(root)


def read_shard(spark: SparkSession, root: str, shard_index: int) -> DataFrame:
    d = spark.read.parquet(root).where(F.col("shard_index") == shard_index)
    bad = F.raise_error(F.concat(F.lit("shard of another contract version: "), F.col("contract_version").cast("string"))).cast("int")
    return d.withColumn("contract_version", F.when(F.col("contract_version") == CONTRACT_VERSION, F.col("contract_version")).otherwise(bad))


def fingerprint(config: dict) -> str:
    """Identity of the settings a detection pass depends on; thresholds that apply afterwards are left out, the sweep's is not."""
    import hashlib

    kept = {k: v for k, v in sorted(config.items()) if k not in AFTERWARDS}
    return hashlib.sha256(json.dumps(kept, sort_keys=True, default=str).encode()).hexdigest()


def read_checkpoint(lines: DataFrame, current: str) -> DataFrame:
    """lines: clip_id, line_no, value (JSON). Line 0 holds the fingerprint; another or none voids the clip's lines. Only
    the last line may be broken; an earlier one is an error. Gives the attempted frames with their detections."""
    det = "array<struct<cls:string,x1:double,y1:double,x2:double,y2:double,score:double>>"
    x = lines.withColumn("j", F.from_json("value", f"struct<fingerprint:string,frame_idx:bigint,detections:{det}>"))
    w = Window.partitionBy("clip_id")
    x = x.withColumn("fp", F.max(F.when(F.col("line_no") == 0, F.col("j.fingerprint"))).over(w)).withColumn("last", F.max("line_no").over(w))
    x = x.where((F.col("fp") == current) & (F.col("line_no") > 0))
    broken = F.col("j.frame_idx").isNull()
    x = x.where(~broken | F.when(F.col("line_no") < F.col("last"), F.raise_error(F.lit("checkpoint broken before its end")).cast("boolean")).otherwise(F.lit(False)))
    return x.select("clip_id", F.col("j.frame_idx").alias("frame_idx"), F.coalesce("j.detections", F.array().cast(det)).alias("detections"))


def _listed(forced: DataFrame, clips: DataFrame) -> DataFrame:
    """Reviewer's boxes of known clips, corners in order and clipped to the frame; real says which have an area."""
    j = forced.join(clips.select("clip_id", "n_frames", "width", "height"), "clip_id")
    bad = (F.col("frame_idx") < 0) | (F.col("frame_idx") >= F.col("n_frames"))
    j = j.withColumn("frame_idx", F.when(~bad, F.col("frame_idx")).otherwise(F.raise_error(F.lit("forced box outside its clip")).cast("long")))
    lo, hi = (lambda a, b: F.greatest(F.lit(0.0), F.least(a, b))), (lambda a, b, m: F.least(F.col(m).cast("double"), F.greatest(F.col(a), F.col(b))))
    j = j.select("clip_id", "frame_idx", lo("x1", "x2").alias("x1"), lo("y1", "y2").alias("y1"), hi("x1", "x2", "width").alias("x2"), hi("y1", "y2", "height").alias("y2"))
    return j.withColumn("real", F.expr("coalesce(x2 > x1 and y2 > y1, false)"))


def forced_boxes(forced: DataFrame, clips: DataFrame) -> DataFrame:
    """Reviewer's boxes (clip_id, frame_idx, x1, y1, x2, y2) for known clips: corners put in order, clipped to the
    frame, empty ones left out. A frame outside its clip is an error. Unknown clips have no rows."""
    return _listed(forced, clips).where("real").drop("real")


def forced_fills(forced: DataFrame, clips: DataFrame, rules, width: int, height: int) -> DataFrame:
    """Fill boxes of a reviewer's boxes: they become tracks like detections of full score, however small, so the frames
    between and around the listed ones are filled too. A listed clip of which no box is left is an error."""
    from dataclasses import replace

    from ..operators import tracks

    usable = forced_boxes(forced, clips)
    lost = _listed(forced, clips).groupBy("clip_id").agg(F.bool_or("real").alias("any")).where("not any").select("clip_id").take(5)
    if lost:
        raise ValueError(f"no forced box is left of {[r[0] for r in lost]}")
    seq = F.row_number().over(Window.partitionBy("clip_id").orderBy("frame_idx", "x1", "y1", "x2", "y2"))
    dets = usable.withColumns({"cls": F.lit("face"), "score": F.lit(1.0), "det_seq": seq.cast("long")})
    rules = replace(rules, min_box=0, keep=None)
    return tracks.fill_boxes(tracks.densify(tracks.build_tracks(dets, rules), rules), width, height)


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """One manifest, or all *.manifest.json of a folder by name."""
    r = spark.read.option("multiLine", True)
    d = r.json(target) if target.endswith(".json") else r.option("pathGlobFilter", "*.manifest.json").json(target)
    return d.withColumn("_file", F.col("_metadata.file_name")).orderBy("_file")


def manifest_rows(clips: DataFrame, audit: DataFrame) -> DataFrame:
    """Manifest documents: clip_id and JSON of source, audit and status."""
    a = audit.select("clip_id", F.struct(*[c for c in audit.columns if c not in ("clip_id", "status")]).alias("audit"), "status")
    src = [c for c in clips.columns if c != "clip_id"]
    return clips.join(a, "clip_id").select("clip_id", F.to_json(F.struct("clip_id", F.struct(*src).alias("source"), "audit", "status")).alias("json"))


def summary_markdown(audit: DataFrame) -> DataFrame:
    """Human summary of an audit, reasons first."""
    lines = F.concat_ws("\n", F.concat(F.lit("# "), F.col("clip_id").cast("string")), F.concat(F.lit("Status: "), F.col("status")), F.array_join(F.transform("reasons", lambda r: F.concat(F.lit("- "), r)), "\n"))
    return audit.select("clip_id", lines.alias("markdown"))


def replay(windows: DataFrame, fixture: list[str]) -> DataFrame:
    """Response n of a fixture is its line n modulo its length; blank lines do not count. windows: window_idx."""
    texts = [json.loads(x)["response_text"] for x in fixture if x.strip()]
    if not texts:
        raise ValueError("empty fixture")
    return windows.withColumn("response_text", F.get(F.array(*map(F.lit, texts)), F.pmod("window_idx", F.lit(len(texts))).cast("int")))


def load_registry(path: str) -> dict[str, dict]:
    """Model registry; unknown keys and missing ones are errors."""
    with open(path, "rb") as f:
        doc = tomllib.load(f)
    for name, entry in doc.get("models", {}).items():
        if extra := set(entry) - MODEL_KEYS:
            raise ValueError(f"{name}: unknown keys {sorted(extra)}")
        need = REQUIRED_KEYS | ({"model"} if entry.get("backend") == HTTP_BACKEND else set())
        if lack := need - set(entry):
            raise ValueError(f"{name}: missing keys {sorted(lack)}")
    return doc.get("models", {})


def model_entry(path: str, name: str) -> dict:
    """One model's entry; an HTTP model without an address takes the backend's default one, and without either is an
    error, as is an unknown name."""
    models = load_registry(path)
    if name not in models:
        raise KeyError(f"{name} is not in the registry; it has {sorted(models)}")
    entry = dict(models[name])
    if entry["backend"] == HTTP_BACKEND and not entry.get("base_url"):
        with open(path, "rb") as f:
            entry["base_url"] = tomllib.load(f).get("backend", {}).get(HTTP_BACKEND, {}).get("base_url")
        if not entry["base_url"]:
            raise ValueError(f"{name}: no base_url, and the backend has no default one")
    return entry


def load_prompt(path: str) -> tuple[str, str]:
    """A prompt template and its hash; an empty one is an error."""
    import hashlib

    with open(path, encoding="utf-8") as f:
        text = f.read()
    if not text.strip():
        raise ValueError(f"{path} is empty")
    return text, "sha256:" + hashlib.sha256(text.encode()).hexdigest()[:16]


def run_manifest(audit: DataFrame) -> DataFrame:
    """One row: how many clips have each status, and the ids of failed ones in order."""
    by = F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n"))))
    n = audit.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("status") == "FAILED", F.col("clip_id")))).alias("failed"))
    return n.agg(by.alias("clips_by_status"), F.array_sort(F.flatten(F.collect_list("failed"))).alias("failed_ids"))


def clips_to_do(clips: DataFrame, manifests: DataFrame, config_hash: str) -> DataFrame:
    """Clips without a whole manifest of this configuration. manifests: clip_id, config_hash; a torn one has null there
    and does not count."""
    done = manifests.where(F.col("config_hash") == config_hash).select("clip_id").distinct()
    return clips.join(done, "clip_id", "left_anti")


def append_checkpoint(attempts: DataFrame, root: str, current: str) -> None:
    """Appends attempted frames (clip_id, frame_idx, detections, empty ones too) under the fingerprint of their settings.
    An append is committed whole or not at all."""
    attempts.select("clip_id", "frame_idx", "detections", F.lit(current).alias("fingerprint")).write.mode("append").partitionBy("fingerprint").parquet(root)


def attempted(spark: SparkSession, root: str, current: str) -> DataFrame:
    """Frames attempted under this fingerprint, each once, however often an attempt was repeated."""
    d = spark.read.parquet(root).where(F.col("fingerprint") == current).drop("fingerprint")
    return d.groupBy("clip_id", "frame_idx").agg(F.first("detections").alias("detections"))


def frames_to_do(frames: DataFrame, done: DataFrame) -> DataFrame:
    """Frames that were not attempted; one without a detection was."""
    return frames.join(done.select("clip_id", "frame_idx"), ["clip_id", "frame_idx"], "left_anti")
