"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import exact_dedup, near_dedup, packing, pii, toxicity
from trackloom.llm.common import cut, mark, sweep, table


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; null and empty texts and documents without labels stay or go by their
    score alone, repeated rows alike."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays; null and empty texts are one text, a null id sorts last."""
    return exact_dedup.drop_copies(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the row with the smallest id stays; texts without
    words and rows with a null id stay."""
    return near_dedup.drop_near_copies(docs)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms under the session's key; n_chars follows the text, null for a null one."""
    return pii.pseudonymise(docs, pii.session_key(spark)).withColumn("n_chars", F.length("text").cast("long"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in their sequences; null and empty texts are one end token."""
    return packing.pack(docs, packing.word_tokenizer_path())


STAGES = [
    ("toxicity", stage_toxicity),
    ("exact_dedup", stage_exact_dedup),
    ("near_dedup", stage_near_dedup),
    ("pii", stage_pii),
    ("packing", stage_packing),
]

#: Trained weights, hashed signatures and a tokenizer have no SQL form; tests/llm/test_pipeline.py holds the stages against
#: plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    since = mark()
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
        sweep(since, docs)  # a stage's scratch tables and its input are not read again
    return docs
