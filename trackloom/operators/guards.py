"""Checks of a run's settings before anything is read."""

from __future__ import annotations

import os


def check(c: dict) -> dict:
    """The settings, with probe_dir filled in. Every fault is an error that names the setting. c: dilate_scale,
    motion_margin, detect_hz, hold, back_hold, min_box, batch, resize (or None), face_threshold, lp_threshold,
    sweep_threshold, continue_threshold (0 or None: none), output_dir, probe_dir (or None)."""

    def need(ok: bool, name: str, rule: str) -> None:
        if not ok:
            raise ValueError(f"{name} = {c[name]}: {rule}")

    operating = min(c["face_threshold"], c["lp_threshold"])
    need(c["dilate_scale"] >= 1, "dilate_scale", "a box may not shrink")
    for name in ("motion_margin", "hold", "back_hold", "min_box"):
        need(c[name] >= 0, name, "must not be negative")
    need(c["detect_hz"] > 0, "detect_hz", "must be positive")
    need(c["batch"] >= 1, "batch", "must be 1 or more")
    need(c.get("resize") is None or c["resize"] >= 64, "resize", "must be 64 or more")
    for name in ("face_threshold", "lp_threshold", "sweep_threshold"):
        need(0 < c[name] <= 1, name, "must be above 0 and at most 1")
    need(c["sweep_threshold"] < operating, "sweep_threshold", "must be below the operating thresholds")
    if c.get("continue_threshold"):
        need(c["sweep_threshold"] <= c["continue_threshold"] < operating, "continue_threshold", "must be from the sweep threshold up to below the operating ones")
    out = os.path.realpath(os.path.expanduser(c["output_dir"]))
    probe = c.get("probe_dir") or os.path.join(os.path.dirname(out), os.path.basename(out) + "-probe")
    probe = os.path.realpath(os.path.expanduser(probe))
    if os.path.commonpath([probe, out]) == out:
        raise ValueError(f"probe_dir = {probe}: must not lie in the output folder")
    return c | {"output_dir": out, "probe_dir": probe}
