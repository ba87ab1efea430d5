"""Frames of videos: decoded, sampled, resized, encoded and published.

A decoder gives the frames of a clip in order, so a clip is the unit of work: one row of the clips table, one partition
of its own, one decoder process where the task runs. Frames leave it in batches of bounded bytes. Decoders and encoders
are commands with {path}, {width}, {height} and {fps} as placeholders; without a command a file is raw planar itself.
Videos and outputs lie on storage that all executors see.
"""

from __future__ import annotations

import os
import subprocess
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import pixels

FRAME = "clip_id long, frame_idx long, width int, height int, raw binary"
#: Bytes of frames in a batch.
BATCH_BYTES = 32 << 20
DECODER = ["ffmpeg", "-loglevel", "error", "-nostdin", "-i", "{path}", "-map", "0:v:0", "-fps_mode", "passthrough", "-f", "rawvideo", "-pix_fmt", "yuv420p", "-"]
ENCODER = ["ffmpeg", "-loglevel", "error", "-y", "-f", "rawvideo", "-pix_fmt", "yuv420p", "-s", "{width}x{height}", "-r", "{fps}", "-i", "-", "-f", "mp4", "{path}"]
UNVERIFIED = ".FAILED-DO-NOT-SHIP"


def frame_bytes(width: int, height: int) -> int:
    if width % 2 or height % 2 or width <= 0 or height <= 0:
        raise ValueError(f"{width}x{height}: planar 4:2:0 needs an even width and height")
    return width * height * 3 // 2


def _command(words: list[str], **values) -> list[str]:
    return [w.format(**values) for w in words]


@contextmanager
def _open(path: str, command: list[str] | None) -> Iterator[BinaryIO]:
    """Raw bytes of a file. What a decoder complains about goes to a file, as an unread pipe would stop it."""
    if command is None:
        with open(path, "rb") as f:
            yield f
        return
    with tempfile.TemporaryFile() as said:
        p = subprocess.Popen(_command(command, path=path), stdout=subprocess.PIPE, stderr=said)
        try:
            yield p.stdout
            if p.wait():
                said.seek(0)
                raise RuntimeError(f"{path}: decoder ended with {p.returncode}: {said.read()[-500:].decode(errors='replace')}")
        finally:
            p.kill()
            p.wait()
            p.stdout.close()


def raw_frames(path: str, width: int, height: int, n_frames: int | None, command: list[str] | None) -> Iterator[bytes]:
    """Frames of a file. A short last one, or another number of frames than n_frames, is an error."""
    size, n = frame_bytes(width, height), 0
    with _open(path, command) as f:
        while buf := f.read(size):
            if len(buf) < size:
                raise RuntimeError(f"{path}: frame {n} has {len(buf)} of {size} bytes")
            n += 1
            yield buf
    if n_frames is not None and n != n_frames:
        raise RuntimeError(f"{path}: {n} of {n_frames} frames decoded")


def _apart(clips: DataFrame) -> DataFrame:
    """Clips dealt out one a partition, or evenly over ten thousand."""
    return clips.repartition(min(max(1, clips.count()), 10_000))


def decode(clips: DataFrame, command: list[str] | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """clips: clip_id, path, width, height, n_frames (null: not known). One row per frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for clip, path, w, h, n in zip(pdf["clip_id"], pdf["path"], pdf["width"], pdf["height"], pdf["n_frames"]):
                most = max(1, batch_bytes // frame_bytes(w, h))
                held, at = [], 0
                for raw in raw_frames(path, w, h, None if pd.isna(n) else int(n), command):
                    held.append(raw)
                    if len(held) == most:
                        yield pd.DataFrame({"clip_id": clip, "frame_idx": range(at, at + most), "width": w, "height": h, "raw": held})
                        held, at = [], at + most
                if held:
                    yield pd.DataFrame({"clip_id": clip, "frame_idx": range(at, at + len(held)), "width": w, "height": h, "raw": held})

    return _apart(clips.select("clip_id", "path", "width", "height", "n_frames")).mapInPandas(run, FRAME)


def sample(frames: DataFrame, fps: tuple[int, int], rate: tuple[int, int]) -> DataFrame:
    """Frames at a rational rate, numbered anew, with source_idx; frames of a rate above the source's come twice."""
    f = frames.withColumn("_at", F.explode(S.output_slots(F.col("frame_idx"), fps, rate)))
    return f.withColumnRenamed("frame_idx", "source_idx").withColumnRenamed("_at", "frame_idx")


def timelapse(frames: DataFrame, fps: tuple[int, int], play: int = 15) -> DataFrame:
    """One frame a second, with the millisecond at which it is shown."""
    return sample(frames, fps, (1, 1)).withColumn("shown_ms", F.floor(F.col("frame_idx") * 1000 / play).cast("long"))


def fitted(width: int, height: int, long_edge: int) -> tuple[int, int]:
    """Size with this longer edge; the other keeps the shape and is even."""
    even = lambda x: max(2, 2 * int(x / 2 + 0.5))
    return (long_edge, even(height * long_edge / width)) if width > height else (even(width * long_edge / height), long_edge)


def scaled(plane: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, sample centres aligned."""

    def axis(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.floor(x).astype(int)
        return lo, np.minimum(lo + 1, n - 1), x - lo

    (a, b, t), (c, d, u) = axis(plane.shape[0], height), axis(plane.shape[1], width)
    p = plane.astype(np.float64)
    p = p[a] * (1 - t)[:, None] + p[b] * t[:, None]
    return np.rint(p[:, c] * (1 - u) + p[:, d] * u).astype(np.uint8)


def resize(frames: DataFrame, long_edge: int) -> DataFrame:
    """The frames with their longer edge this long (an even number)."""
    frame_bytes(long_edge, long_edge)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raws, ws, hs = [], [], []
            for raw, w, h in zip(pdf["raw"], pdf["width"], pdf["height"]):
                w2, h2 = fitted(w, h, long_edge)
                y, u, v = pixels.planes(raw, w, h)
                raws.append(b"".join(scaled(p, *s).tobytes() for p, s in ((y, (w2, h2)), (u, (w2 // 2, h2 // 2)), (v, (w2 // 2, h2 // 2)))))
                ws.append(w2)
                hs.append(h2)
            yield pdf.assign(raw=raws, width=np.array(ws, "int32"), height=np.array(hs, "int32"))

    return frames.mapInPandas(run, frames.schema)


def encode(frames: DataFrame, folder: str, fps: str, command: list[str] | None = None, suffix: str = ".mp4") -> DataFrame:
    """Writes each clip's frames, in order, into one file of the folder that no reader takes for a finished one, and
    gives clip_id, path, n_frames; `publish` names it once it is verified. A task that is run again begins its files
    anew. Frames stream through; only one is held."""
    rows = frames.select(*[c.split()[0] for c in FRAME.split(", ")]).repartition("clip_id").sortWithinPartitions("clip_id", "frame_idx")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        os.makedirs(folder, exist_ok=True)
        clip = out = proc = part = None
        n, done = 0, []

        def close() -> None:
            out.close()
            if proc is not None and proc.wait():
                raise RuntimeError(f"clip {clip}: encoder ended with {proc.returncode}")
            path = os.path.join(folder, f"{clip}{suffix}{UNVERIFIED}")
            os.replace(part, path)
            done.append((clip, path, n))

        try:
            for pdf in batches:
                for c, w, h, raw in zip(pdf["clip_id"], pdf["width"], pdf["height"], pdf["raw"]):
                    if c != clip:
                        if out is not None:
                            close()
                        clip, n, part = c, 0, os.path.join(folder, f".{c}-{uuid.uuid4().hex}.part")
                        proc = None if command is None else subprocess.Popen(_command(command, path=part, width=w, height=h, fps=fps), stdin=subprocess.PIPE)
                        out = open(part, "wb") if proc is None else proc.stdin
                    out.write(raw)
                    n += 1
            if out is not None:
                close()
        finally:
            if proc is not None and proc.poll() is None:
                proc.kill()
            if part is not None and os.path.exists(part):
                os.remove(part)
        yield pd.DataFrame(done, columns=["clip_id", "path", "n_frames"])

    return rows.mapInPandas(run, "clip_id long, path string, n_frames long")


def publish(written: DataFrame, status: DataFrame) -> DataFrame:
    """Files of clips whose status is not FAILED get their own name; the others stay quarantined, as evidence. written:
    clip_id, path; status: clip_id, status (none: FAILED). Gives clip_id, status, path."""
    rows = written.select("clip_id", "path").join(status.select("clip_id", "status"), "clip_id", "left")
    rows = rows.select("clip_id", F.coalesce("status", F.lit("FAILED")).alias("status"), "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            paths = []
            for path, s in zip(pdf["path"], pdf["status"]):
                final = path.removesuffix(UNVERIFIED)
                if s != "FAILED":
                    if os.path.exists(path):  # not so if a lost task had come this far
                        os.replace(path, final)
                    path = final
                paths.append(path)
            yield pdf.assign(path=paths)

    return rows.mapInPandas(run, "clip_id long, status string, path string")


def digests(files: DataFrame) -> DataFrame:
    """path, sha256 of each file, read in blocks: a video does not fit in a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                with open(path.removeprefix("file:"), "rb") as f:
                    out.append((path, hashlib.file_digest(f, "sha256").hexdigest()))
            yield pd.DataFrame(out, columns=["path", "sha256"])

    return _apart(files.select("path")).mapInPandas(run, "path string, sha256 string")
