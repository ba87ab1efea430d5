"""Scalar rules as Column expressions. All stay in the JVM.

Rounding is half-to-even (rint). Trimming takes all Unicode white space, as the rules want, not blanks alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules.
WINDOW_FRAMES = 8
FRAME_MS = 750
CAPS = {"what": 400, "how": 400, "why": 240, "location": 60, "verb": 40, "object": 80, "target": 80, "tool": 24}
CONTACTS = ("grip", "push", "pull", "tap", "slide", "twist", "pinch", "reach", "release", "none")
COORDINATION = ("independent", "supporting", "coordinated", "none")

_SPACE = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _SPACE, "")


def clamp_text(c: Column, cap: int) -> Column:
    """Trimmed, cut to cap characters; nothing left is null."""
    return F.nullif(F.substring(strip(c), 1, cap), F.lit(""))


def vocab(c: Column, words: tuple[str, ...]) -> Column:
    x = F.lower(strip(c))
    return F.when(x.isin(*words), x)


def slug(c: Column) -> Column:
    """Lower-case words joined by underscores, 24 characters at most, beginning with a letter; else null."""
    x = F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_")
    x = F.substring(F.regexp_replace(x, "^_+|_+$", ""), 1, 24)
    return F.when(x.rlike("^[a-z][a-z0-9_]{0,23}$"), x)


def strip_fence(c: Column) -> Column:
    """Text without one surrounding code fence. Anchored patterns only, so linear in the text."""
    x = strip(c)
    inner = strip(F.regexp_replace(x, r"^```(?:json)?[ \t]*\n?", ""))
    inner = F.when(F.endswith(inner, F.lit("```")), strip(F.substring(inner, F.lit(1), F.length(inner) - 3))).otherwise(inner)
    return F.when(F.startswith(x, F.lit("```")), inner).otherwise(x)


def prompt_hash(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(c, 256), 1, 16))


def content_id(stem: Column, content: Column) -> Column:
    """Stem and eight hex digits of the first 8 MiB; empty content is an error."""
    head = F.substring(content, 1, 8 * 1024 * 1024)
    return F.when(F.length(content) == 0, F.raise_error(F.lit("empty file"))).otherwise(F.concat(stem, F.lit("-"), F.substring(F.sha2(head, 256), 1, 8)))


def rate_lenient(c: Column) -> Column:
    """n/d, with 0.0 where the denominator is 0 or missing parts make no number."""
    n, d = (F.try_element_at(F.split(c, "/"), F.lit(i)).try_cast("double") for i in (1, 2))
    d = F.when(F.instr(c, "/") > 0, d).otherwise(F.lit(1.0))
    return F.when(d == 0, F.lit(0.0)).otherwise(n / F.nullif(d, F.lit(0.0)))


def rate_strict(c: Column) -> Column:
    """n/d with the denominator no less than 1e-9; what is not a positive number is an error."""
    n, d = (F.try_element_at(F.split(c, "/"), F.lit(i)).try_cast("double") for i in (1, 2))
    d = F.when(F.instr(c, "/") > 0, d).otherwise(F.lit(1.0))
    r = n / F.greatest(d, F.lit(1e-9))
    return F.when(r.isNull() | (r <= 0), F.raise_error(F.concat(F.lit("unusable frame rate: "), F.coalesce(c, F.lit("null"))))).otherwise(r)


def is_variable_rate(avg: Column, real: Column) -> Column:
    """Probe's flag: absolute difference over 0.05."""
    return F.abs(avg - real) > 0.05


def is_constant_rate(avg: Column, real: Column) -> Column:
    """The job's test: relative difference of 0.001 at most, of a positive rate."""
    return (real > 0) & (F.abs(real - avg) / F.nullif(real, F.lit(0.0)) <= 0.001)


def stride(fps: Column, hz: Column) -> Column:
    return F.greatest(F.lit(1), F.rint(fps / hz)).cast("long")


def holds(fps: Column, forward: Column, backward: Column) -> tuple[Column, Column]:
    """Forward hold: given, or the frames of a second at 0. Backward: given, or the forward one at 0."""
    f = F.when(forward == 0, F.rint(fps)).otherwise(forward).cast("long")
    return f, F.when(backward == 0, f).otherwise(backward).cast("long")


def chapter(name: Column) -> tuple[Column, Column]:
    """GXjjcccc -> (cccc, jj); other names are their own group, chapter 0."""
    pat = r"^(?i)GX(\d{2})(\d{4})$"
    hit = name.rlike(pat)
    return F.when(hit, F.regexp_extract(name, pat, 2)).otherwise(name), F.when(hit, F.regexp_extract(name, pat, 1).cast("int")).otherwise(F.lit(0))


def window_clock(first: Column, last: Column) -> tuple[Column, Column]:
    """Milliseconds of a window on the 4/3 fps clock, exactly."""
    return (first * FRAME_MS).cast("long"), ((last + 1) * FRAME_MS).cast("long")


def seconds_text(n_frames: Column) -> Column:
    """n*0.75 without trailing zeros."""
    return F.regexp_replace(F.format_string("%.2f", n_frames * F.lit(0.75)), r"\.?0+$", "")


def render_prompt(template: Column, n: Column) -> Column:
    x = F.replace(template, F.lit("{n_frames}"), n.cast("string"))
    x = F.replace(x, F.lit("{max_frame_idx}"), (n - 1).cast("string"))
    x = F.replace(x, F.lit("{window_seconds}"), seconds_text(n))
    return F.when(n < 1, F.raise_error(F.lit("a window has at least one frame"))).otherwise(x)


def frame_labels(n: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("Frame "), i.cast("string")))


def call_cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    """USD of a call at prices a million tokens; null if a count is."""
    return (tokens_in * price_in + tokens_out * price_out) / 1e6


def clock_text(frame: Column, fps: Column) -> Column:
    """MM:SS.ss of a frame."""
    s = frame / fps
    return F.format_string("%02d:%05.2f", F.floor(s / 60).cast("int"), s - 60 * F.floor(s / 60))


def now_text() -> Column:
    """The present second in UTC, like 2024-05-01T10:00:00Z."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def flat_landmarks(points: Column) -> Column:
    """x, y, z of each landmark (an array of structs) in one array of floats."""
    return F.flatten(F.transform(points, lambda p: F.array(p["x"], p["y"], p["z"]))).cast("array<float>")


def wrist(flat: Column) -> tuple[Column, Column]:
    """x and y of the wrist, the first landmark of a flat array; null without one."""
    return F.get(flat, F.lit(0)), F.get(flat, F.lit(1))


def limited_range(luma: Column, chroma: Column) -> tuple[Column, Column]:
    """Samples of full range in limited range: luma to 16..235, chroma to 16..240, halves to even."""
    return F.rint(16 + luma * (219 / 255)).cast("int"), F.rint(16 + chroma * (224 / 255)).cast("int")


def output_slots(idx: Column, fps: tuple[int, int], rate: tuple[int, int]) -> Column:
    """Numbers of the frames of an output of a rational rate that show source frame idx, in whole numbers: its time is
    rounded to the nearest output frame, halves up, and the last source frame that falls on one is shown."""
    up, down = fps[1] * rate[0], fps[0] * rate[1]
    slot = lambda i: F.floor((i * 2 * up + down) / (2 * down))
    a, b = slot(idx), slot(idx + 1)
    return F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
