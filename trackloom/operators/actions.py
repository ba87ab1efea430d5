"""Semi-structured model responses: repair, validation and normalisation of actions.

The ladder runs in one Arrow-batched UDF, because lax validation (numbers in strings, flags in words) has no JVM
counterpart; it returns a typed array, and everything after it is column expressions. No text ever raises.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..functions.scalars import CAPS, CONTACTS, COORDINATION

_HAND = "struct<verb:string,object:string,target:string,contact_type:string,visible:boolean>"
ACTION = f"struct<start_frame:int,end_frame:int,task_step:string,left_hand:{_HAND},right_hand:{_HAND},tool_in_use:string,coordination:string,handover_event:boolean,scene_what:string,scene_how:string,scene_why:string,scene_location:string>"
_TEXT_KEYS = ("task_step", "tool_in_use", "coordination", "what", "how", "why", "location")


def strip_fence(text: str) -> str:
    t = text.strip()
    if not t.startswith("```"):
        return t
    t = re.sub(r"^```(?:json)?[ \t]*\n?", "", t).strip()
    return t[:-3].strip() if t.endswith("```") else t


def _no_constant(name: str):
    raise ValueError(name)


def repair(text: str) -> object | None:
    """JSON with small faults: single quotes, bare keys, commas before a bracket, brackets left open."""
    at = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    if at < 0:
        return None
    out: list[str] = []
    stack: list[str] = []
    i, n = at, len(text)
    while i < n:
        c = text[i]
        if c in "\"'":
            j = i + 1
            while j < n and text[j] != c:
                j += 2 if text[j] == "\\" else 1
            body = text[i + 1 : j]
            out.append(json.dumps(body) if c == "'" else '"' + body.replace("\n", "\\n") + '"')
            i = j + 1
            continue
        if c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]":
            while out and not out[-1].strip():
                out.pop()
            if out and out[-1] == ",":
                out.pop()
            if not stack:
                break
            out.append(stack.pop())
            i += 1
            if not stack:
                break
            continue
        elif m := re.compile(r"[A-Za-z_][A-Za-z0-9_]*").match(text, i):
            word = m[0]
            out.append(word if word in ("true", "false", "null") else {"True": "true", "False": "false", "None": "null"}.get(word, json.dumps(word)))
            i = m.end()
            continue
        out.append(c)
        i += 1
    while out and (not out[-1].strip() or out[-1] == ","):
        out.pop()
    try:
        return json.loads("".join(out + stack[::-1]), parse_constant=_no_constant)
    except ValueError:
        return None


_LONE = re.compile("[\ud800-\udfff]")


class _Bad(ValueError):
    pass


def _int(v: object) -> int:
    """A frame number of 32 bits; anything else does not validate."""
    n = None
    if isinstance(v, (bool, int)):
        n = int(v)
    elif isinstance(v, float) and v.is_integer():
        n = int(v)
    elif isinstance(v, str) and re.fullmatch(r"\s*[+-]?\d{1,20}(\.0*)?\s*", v):
        n = int(v.strip().split(".")[0])
    if n is None or not -(1 << 31) <= n < 1 << 31:
        raise _Bad
    return n


def _str(v: object) -> str | None:
    """Text; half a surrogate pair is none and does not validate."""
    if v is None or (isinstance(v, str) and not _LONE.search(v)):
        return v
    raise _Bad


def _bool(v: object) -> bool | None:
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) and v in (0, 1):
        return bool(v)
    if isinstance(v, str):
        w = v.lower()
        if w in ("1", "true", "t", "yes", "y", "on"):
            return True
        if w in ("0", "false", "f", "no", "n", "off"):
            return False
    raise _Bad


def _block(v: dict, key: str) -> dict:
    b = v.get(key, {})
    if not isinstance(b, dict):
        raise _Bad
    return b


def _clamp(v: str | None, cap: int) -> str | None:
    return (v.strip()[:cap] or None) if v is not None else None


def _word(v: str | None, words: tuple[str, ...]) -> str | None:
    x = v.strip().lower() if v is not None else None
    return x if x in words else None


def _slug(v: str | None) -> str | None:
    if v is None:
        return None
    x = re.sub(r"[^a-z0-9]+", "_", v.strip().lower()).strip("_")[:24]
    return x if re.fullmatch(r"[a-z][a-z0-9_]{0,23}", x) else None


def _hand(b: dict) -> tuple:
    verb, obj, target = (_clamp(_str(b.get(k)), CAPS[k]) for k in ("verb", "object", "target"))
    contact, visible = _word(_str(b.get("contact_type")), CONTACTS), _bool(b.get("visible"))
    if visible is False or (visible and verb is None):  # a hand that does nothing is not seen
        return None, None, None, None, False
    return verb, obj, target, contact, visible


def _action(v: object) -> tuple:
    if not isinstance(v, dict) or "start_frame" not in v or "end_frame" not in v:
        raise _Bad
    scene = _block(v, "scene")
    return (
        _int(v["start_frame"]), _int(v["end_frame"]), _slug(_str(v.get("task_step"))), _hand(_block(v, "left_hand")), _hand(_block(v, "right_hand")),
        _clamp(_str(v.get("tool_in_use")), CAPS["tool"]), _word(_str(v.get("coordination")), COORDINATION), _bool(v.get("handover_event")),
        *(_clamp(_str(scene.get(k)), CAPS[k]) for k in ("what", "how", "why", "location")),
    )


def parse(text: str | None, n_frames: int) -> tuple[list[tuple], bool]:
    """(actions, schema_ok). Valid JSON with a bad frame range keeps its actions; what does not validate becomes one
    action over the whole window from whatever fields a pattern finds."""
    body = strip_fence(text or "")
    try:
        v = json.loads(body)
    except (ValueError, RecursionError):
        v = None
    if v is None:
        try:
            v = repair(body)
        except RecursionError:
            v = None
    if isinstance(v, list):
        v = {"actions": v}
    try:
        acts = v.get("actions") if isinstance(v, dict) else None
        if isinstance(acts, list) and acts:
            rows = [_action(a) for a in acts]
            return rows, all(0 <= r[0] <= r[1] <= n_frames - 1 for r in rows)
    except _Bad:
        pass
    grab = {k: (m[1] if (m := re.search(rf'"{k}"\s*:\s*"([^"]*)"', body)) else None) for k in _TEXT_KEYS}
    blank = (None, None, None, None, None)
    return [(
        0, max(0, n_frames - 1), _slug(grab["task_step"]), blank, blank, _clamp(grab["tool_in_use"], CAPS["tool"]), _word(grab["coordination"], COORDINATION), None,
        *(_clamp(grab[k], CAPS[k]) for k in ("what", "how", "why", "location")),
    )], False


def parse_responses(responses: DataFrame, text: str = "response_text", frames: str = "n_frames") -> DataFrame:
    """responses with actions and schema_ok behind their columns; the text itself stays the raw record."""
    hand = ("verb", "object", "target", "contact_type", "visible")
    names = [x.split(":")[0] for x in re.sub(r"struct<[^<>]*>", "", ACTION[len("struct<") : -1]).split(",")]

    def as_dict(a: tuple) -> dict:
        d = dict(zip(names, a))
        d["left_hand"], d["right_hand"] = dict(zip(hand, a[3])), dict(zip(hand, a[4]))
        return d

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(t, int(n)) for t, n in zip(pdf[text], pdf[frames])]
            yield pdf.assign(actions=[[as_dict(a) for a in g[0]] for g in got], schema_ok=[g[1] for g in got])

    added = StructType.fromDDL(f"actions array<{ACTION}>, schema_ok boolean")
    return responses.mapInPandas(run, StructType([*responses.schema.fields, *added.fields]))
