"""Model backends behind one contract, called from Arrow batches; spend is checked between waves on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Response:
    text: str
    latency_s: float = 0.0
    tokens_in: int | None = None
    tokens_out: int | None = None
    provider: str | None = None


class Backend(Protocol):
    name: str
    model_id: str

    def caption(self, frames: list[bytes], prompt: str) -> Response: ...


class SpendLimit(RuntimeError):
    """The run's budget is used up."""


class Permanent(RuntimeError):
    """An error that a repeated call cannot mend."""


class Replay:
    """Deterministic backend over fixed responses, in turn."""

    name = "fake"

    def __init__(self, texts: list[str], model_id: str = "fake") -> None:
        self.texts, self.model_id, self.n = texts, model_id, 0

    def caption(self, frames: list[bytes], prompt: str) -> Response:
        self.n += 1
        return Response(self.texts[(self.n - 1) % len(self.texts)], tokens_in=len(prompt), tokens_out=len(frames))


RESULT = "video_id long, window_idx long, response_text string, tokens_in long, tokens_out long, error string, fatal boolean"


def call(windows: DataFrame, make: Callable[[], Backend]) -> DataFrame:
    """windows: video_id, window_idx, n_frames, prompt, and frames (array of binary images) where the backend looks at
    them. A failed call is an error row; a fatal one is marked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                try:
                    shown = getattr(r, "frames", None)
                    x = backend.caption([b""] * int(r.n_frames) if shown is None else [bytes(i) for i in shown], r.prompt)
                    rows.append((r.video_id, r.window_idx, x.text, x.tokens_in, x.tokens_out, None, False))
                except (SpendLimit, Permanent) as e:
                    rows.append((r.video_id, r.window_idx, None, None, None, f"{type(e).__name__}: {e}", True))
                except Exception as e:  # noqa: BLE001  one window's failure is its own row
                    rows.append((r.video_id, r.window_idx, None, None, None, f"{type(e).__name__}: {e}", False))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return windows.mapInPandas(run, RESULT)


def in_waves(windows: DataFrame, make: Callable[[], Backend], sink: Callable[[DataFrame], object], wave: int, cap_usd: float | None, prices: tuple[float, float]) -> float:
    """Runs windows wave by wave; after each one the rows go to the sink, and a spend at or over the cap, or a fatal
    error, stops the run. A wave bounds the overrun. Gives the spend."""
    if cap_usd is not None and prices == (0.0, 0.0):
        raise ValueError("a cap needs prices")
    spent, k = 0.0, 0
    todo = ranked(windows, wave)
    top = todo.agg(F.max("_wave")).first()[0]
    while top is not None and k <= top:
        if cap_usd is not None and spent >= cap_usd:
            raise SpendLimit(f"{spent:.4f} of {cap_usd:.4f} USD")
        # Checkpointed before anything reads it, so no call is made twice.
        rows = call(todo.where(F.col("_wave") == k).drop("_wave"), make).checkpoint()
        sink(rows)
        usd = (F.col("tokens_in") * prices[0] + F.col("tokens_out") * prices[1]) / 1e6
        unknown = F.count_if(F.col("error").isNull() & usd.isNull())
        s = rows.agg(F.sum(usd), F.max(F.when(F.col("fatal"), F.col("error"))), unknown).first()
        spent += s[0] or 0.0
        if s[1]:
            raise Permanent(s[1])
        if cap_usd is not None and s[2]:
            raise Permanent(f"{s[2]} answers without usage under a spend cap")
        k += 1
    return spent


def ranked(windows: DataFrame, wave: int) -> DataFrame:
    """windows with _wave, the number of their wave in order of video and window. Ranges are counted, then numbered each
    for itself; only the counts of the ranges meet on the driver."""
    d = windows.repartitionByRange("video_id", "window_idx").withColumn("_range", F.spark_partition_id()).checkpoint()
    before, at = {}, 0
    for r in d.groupBy("_range").count().orderBy("_range").collect():
        before[r[0]], at = at, at + r[1]
    base = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else F.create_map(F.lit(0), F.lit(0))
    w = Window.partitionBy("_range").orderBy("video_id", "window_idx")
    place = F.row_number().over(w) - 1 + base[F.col("_range")]
    return d.withColumn("_wave", F.floor(place / wave).cast("int")).drop("_range")


#: Answers of a server that a retry cannot change.
FINAL_STATUS = (400, 401, 402, 403, 404, 422)


class StatusError(RuntimeError):
    def __init__(self, status: int, message: str = "") -> None:
        super().__init__(f"status {status} {message}".strip())
        self.status = status


class Retrying:
    """A backend that asks again, twice at most, after 1 and 2 seconds; final answers of the server are permanent."""

    def __init__(self, inner: Backend, attempts: int = 3, sleep: Callable[[float], None] | None = None) -> None:
        import time

        self.inner, self.attempts, self.sleep = inner, attempts, sleep or time.sleep

    def caption(self, images: list[bytes], prompt: str):
        for n in range(self.attempts):
            try:
                return self.inner.caption(images, prompt)
            except (SpendLimit, Permanent):
                raise
            except StatusError as e:
                if e.status in FINAL_STATUS:
                    raise Permanent(str(e)) from e
                if n + 1 == self.attempts:
                    raise
            except Exception:
                if n + 1 == self.attempts:
                    raise
            self.sleep(2.0**n)


#: A window's frames must fit into one request.
LEAST_IMAGES = 8
LOOPBACK = ("localhost", "127.0.0.1", "::1")


class Http:
    """A backend behind a chat-completions address. The key is read from the environment of the worker and is never part
    of a plan. A faulty setting is an error before any call is made."""

    name = "openai-compat"

    def __init__(self, entry: dict, key_env: str, timeout: float = 120.0) -> None:
        from urllib.parse import urlsplit

        address = urlsplit(entry["base_url"])
        self.local = address.hostname in LOOPBACK
        if address.scheme != "https" and not (address.scheme == "http" and self.local):
            raise ValueError(f"{entry['base_url']}: must be https, or on this machine")
        if entry.get("max_images", LEAST_IMAGES) < LEAST_IMAGES:
            raise ValueError(f"max_images = {entry['max_images']}: a window has {LEAST_IMAGES} frames")
        if any(x in entry["model"] for x in "<>"):
            raise ValueError(f"{entry['model']}: a placeholder, not a model")
        self.entry, self.model_id, self.key_env, self.timeout = entry, entry["model"], key_env, timeout

    def body(self, frames: list[bytes], prompt: str) -> dict:
        import base64

        detail = {"detail": self.entry["image_detail"]} if self.entry.get("image_detail") else {}
        images = [{"type": "image_url", "image_url": {"url": "data:image/jpeg;base64," + base64.b64encode(f).decode(), **detail}} for f in frames]
        out = {"model": self.model_id, "messages": [{"role": "user", "content": [{"type": "text", "text": prompt}, *images]}]}
        if self.entry.get("provider_order"):
            out["provider"] = {"order": self.entry["provider_order"]}
        if self.entry.get("supports_json_schema"):
            out["response_format"] = {"type": "json_object"}
        return out

    def caption(self, frames: list[bytes], prompt: str) -> Response:
        import json
        import os
        import time
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        if len(frames) > self.entry.get("max_images", len(frames)):
            raise Permanent(f"{len(frames)} images, at most {self.entry['max_images']}")
        key = os.environ.get(self.key_env)
        if not key and not self.local:
            raise Permanent(f"{self.key_env} is not set")
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        request = Request(self.entry["base_url"].rstrip("/") + "/chat/completions", json.dumps(self.body(frames, prompt)).encode(), head)
        began = time.monotonic()
        try:
            with urlopen(request, timeout=self.timeout) as r:
                got = json.load(r)
        except HTTPError as e:
            raise StatusError(e.code, e.read(300).decode("utf-8", "replace")) from e
        usage = got.get("usage") or {}
        text = got["choices"][0]["message"]["content"] or ""
        return Response(text, time.monotonic() - began, usage.get("prompt_tokens"), usage.get("completion_tokens"), got.get("provider"))


def backend(entry: dict, key_env: str, fixture: list[str] | None = None) -> Callable[[], Backend]:
    """What makes a worker's backend from a registry entry (sources.documents.model_entry). Settings are checked here, on
    the driver."""
    if entry["backend"] == Replay.name:
        if not fixture:
            raise ValueError("a replaying backend needs a fixture")
        return lambda: Replay(fixture, entry.get("model", "fake"))
    if entry["backend"] != Http.name:
        raise ValueError(f"unknown backend {entry['backend']}")
    Http(entry, key_env)
    return lambda: Retrying(Http(entry, key_env))
