"""Toxicity: severity grades by cumulative-link regression on sparse word and stem features.

Severity comes from the ratings alone, never from the features: a table of graded ratings gives as many thresholds as it
has grades above 0. The sample tables hold one 0/1 mark, which allows one threshold; there expected severity is the
probability of grade 1. (Grades made of both marks were tried and lowered the share of toxic rows found.)
The fit shares its weights across the thresholds, over the words and stems that tell toxic rows from
others; a document is scored by the sum of the weights of its distinct words and stems, and gets its expected severity
and the probability of any severity above 0. Rows with that probability at or above `cutoff` are rejected.

Cases: null and empty texts score the bias alone and are kept; repeated rows get equal scores; without labels of both
kinds nothing is rejected (severity 0); extra columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget_others, table
from .ordinal import _LETTERS, CACHE_WORDS, Model, bucket, fit, gather, grade_counts, sample_rows, stands_for, word_parts

#: Labelled rows of each kind in the fit, at most.
SAMPLE = 3000
CUTOFF = 0.35
GRADES = 2


def word_features(text: str) -> dict[str, float]:
    out: dict[str, float] = {}
    for w in set(_LETTERS.findall(text.lower())):
        for part in word_parts(w):
            out[part] = out.get(part, 0.0) + 1.0
    return out


def telling(idx: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, least: float = 6.0, purity: float = 0.7) -> list[np.ndarray]:
    """Features most of whose rows are toxic, beyond chance: the log-likelihood gain over the overall share of toxic
    rows is `least` or more (a chance of one in some 400 a feature). The others, most of all words,
    would add noise to long documents. Rows count as many as they stand for, scaled to the size of the sample, so both
    bounds mean the same whatever was sampled."""
    feats, at = np.unique(np.concatenate(idx), return_inverse=True)
    row = np.repeat(np.arange(len(idx)), [len(x) for x in idx])
    weight = weight * len(idx) / weight.sum()
    anywhere, inside = np.bincount(at, weight[row]), np.bincount(at, (weight * toxic)[row])
    p, q = (weight * toxic).sum() / weight.sum(), inside / anywhere
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(inside > 0, inside * np.log(q / p), 0) + np.where(q < 1, (anywhere - inside) * np.log((1 - q) / (1 - p)), 0)
    good = (q >= purity) & (gain >= least)
    cuts = np.cumsum([len(x) for x in idx])[:-1]
    return np.split(good[at], cuts)


def severities(labels: DataFrame) -> DataFrame:
    """doc_id and grade from the one mark that the labels give."""
    return labels.where("toxic is not null").select("doc_id", F.when(F.col("toxic") == 0, 0).otherwise(1).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """ratings: doc_id and an integer grade from 0 on."""
    counts = grade_counts(ratings, "grade")
    rows = gather(sample_rows(docs, ratings, "grade", sample, counts), word_features)
    grades = np.array([r[3] for r in rows], np.int64)
    n_grades = max(GRADES, max(counts, default=0) + 1)
    if len(set((grades > 0).tolist())) < 2:
        return Model({}, np.full(n_grades - 1, 40.0))
    idx, weight = [r[1] for r in rows], stands_for(counts, sample, grades)
    told = telling(idx, (grades > 0).astype(float), weight)
    return fit([(ix[k], r[2][k].astype(np.float64)) for ix, k, r in zip(idx, told, rows)], grades, n_grades, weight)


def scorer(model: Model):
    """The latent severity of a text: the sum of its distinct words' weights, remembered word by word."""
    w = model.weights
    cache: dict[str, float] = {}

    def of(text: str | None) -> float:
        words = set(_LETTERS.findall(text.lower())) if text else set()
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for x in words.difference(cache):
            cache[x] = sum(w.get(bucket(p), 0.0) for p in word_parts(x))
        return round(sum(sorted(filter(None, map(cache.__getitem__, words)))), 9)

    return of


def score(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """docs with expected_severity, p_toxic and kept behind its columns."""
    severity = scorer(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_others("toxicity")
        for pdf in batches:
            s = np.empty(len(pdf))
            for i, t in enumerate(pdf["text"]):
                s[i] = severity(t)
            tail = model.tail(s)
            yield pdf.drop(columns="text").assign(expected_severity=tail.sum(1).round(6), p_toxic=tail[:, 0].round(6), kept=tail[:, 0] < cutoff)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInPandas(run, "doc_id long, expected_severity double, p_toxic double, kept boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """The rows of docs that are not rejected."""
    model = train(docs if fit_on is None else fit_on, severities(labels))
    return filter_rows(docs, model)


def filter_rows(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """Scores whole rows in one pass: no join brings the verdict back to the row."""
    severity, names = scorer(model), docs.columns

    def run(batches):
        import pyarrow as pa

        forget_others("toxicity")
        for b in batches:
            keep = []
            for t in b.column(names.index("text")).to_pylist():
                keep.append(bool(model.tail(np.array([severity(t)]))[0, 0] < cutoff))
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, severities(table(spark, sf_dir, "labels"))))

