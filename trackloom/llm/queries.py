"""The registered queries of this folder and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, line_dedup, near_dedup, packing, pii, quality, quality_rules, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_quality": quality.op2_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_pii": pii.op6_pii,
    "op7_bpe": bpe.op7_bpe,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_line_dedup": line_dedup.op10_line_dedup,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op9_url_filter": url_filter.SQL,
    "op10_line_dedup": line_dedup.SQL,
}
