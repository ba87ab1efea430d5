"""Quality: expected grade by cumulative-link regression on hashed text.

Ratings 0 to 2: 0 for a row of low quality, 1 for a sound but toxic row, 2 for a sound row that is not (the labels give
two 0/1 marks, and the grade orders them). Hashed features: the words of the text and the shapes of its white-space
tokens (runs of letters and of digits folded, symbols kept), each by the root of its share, and shares of the whole text
(distinct words, repeated lines, the most frequent word, symbols, word length) in steps. One weight vector serves all
thresholds. A document gets its expected grade and the tail probability P(grade >= 1), by which it is kept.

Cases: null and empty texts have the feature "empty" alone; repeated rows get equal grades; without labels of at least
two grades all rows are kept; extra columns are passed over.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .ordinal import CACHE_WORDS, Model, bucket, fit, gather, grade_counts, sample_rows, stands_for

SAMPLE = 3000
GRADES = 3
CUTOFF = 0.5

_RUN = re.compile(r"[^\W\d_]+|[0-9]+")
_WORDS = re.compile(r"[^\W\d_]+")
_SHAPES: dict[str, str] = {}


def _shape(token: str) -> str:
    """The whole token with its runs folded; short ones are remembered."""
    s = _SHAPES.get(token)
    if s is None:
        s = _RUN.sub(lambda m: "9" if "0" <= m[0][0] <= "9" else "a", token)
        if len(token) <= 64:
            if len(_SHAPES) > CACHE_WORDS:
                _SHAPES.clear()
            _SHAPES[token] = s
    return s


def text_features(text: str) -> dict[str, float]:
    words = text.split()
    if not words:
        return {"empty": 1.0}
    n = len(words)
    count = Counter(words)
    shapes: dict[str, int] = {}
    for w, k in count.items():
        s = _shape(w)
        shapes[s] = shapes.get(s, 0) + k
    out = {"s:" + s: (k / n) ** 0.5 for s, k in shapes.items()}
    inner = Counter(_WORDS.findall(text.lower()))
    m = max(1, sum(inner.values()))
    out |= {"w:" + w: (k / m) ** 0.5 for w, k in inner.items()}
    lines = [x for x in text.split("\n") if x.strip()]
    chars = sum(map(len, words))
    steps = {
        "n": min(12, int(np.log2(n))),
        "distinct": int(10 * len(count) / n),
        "top": int(10 * max(count.values()) / n),
        "lines": int(10 * (1 - len(set(lines)) / max(1, len(lines)))),
        "length": min(20, int(chars / n)),
        "letters": int(10 * sum(k * sum(map(str.isalpha, w)) for w, k in count.items()) / max(1, chars)),
        "capital": int(10 * sum(k for w, k in count.items() if w[0].isupper()) / n),
    }
    for k, v in steps.items():
        out[f"{k}:{v}"] = 1.0
    return out


def grades_of(labels: DataFrame) -> DataFrame:
    return labels.where("quality is not null").select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """ratings: doc_id and an integer grade from 0 on."""
    counts = grade_counts(ratings, "grade")
    rows = gather(sample_rows(docs, ratings, "grade", sample, counts), text_features)
    grades = np.array([r[3] for r in rows], np.int64)
    if len(set(grades.tolist())) < 2:
        return Model({}, np.full(GRADES - 1, -40.0))
    data = [(r[1], r[2].astype(np.float64)) for r in rows]
    return fit(data, grades, max(GRADES, int(grades.max()) + 1), stands_for(counts, sample, grades))


def score(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, expected_grade, p_sound (P(grade >= 1)), p_top (P of the top grade), kept."""
    weights = model.weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict[str, float] = {}
        for pdf in batches:
            s = np.zeros(len(pdf))
            for i, t in enumerate(pdf["text"]):
                for name, v in sorted(text_features(t or "").items()):
                    w = places.get(name)
                    if w is None:
                        if len(places) > CACHE_WORDS:
                            places.clear()
                        w = places[name] = weights.get(bucket(name), 0.0)
                    s[i] += w * v
            tail = model.tail(s)
            yield pdf.drop(columns="text").assign(expected_grade=tail.sum(1).round(6), p_sound=tail[:, 0].round(6), p_top=tail[:, -1].round(6), kept=tail[:, 0] >= cutoff)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInPandas(run, "doc_id long, expected_grade double, p_sound double, p_top double, kept boolean")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, grades_of(table(spark, sf_dir, "labels"))))
