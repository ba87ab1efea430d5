"""Cumulative-link (ordinal logistic) regression on hashed text features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector for all grades, ordered thresholds. The fit takes a
bounded sample of rated rows (`sample` rows a grade at most, chosen by a hash of their id, so the choice does not
depend on partitions) and runs on the driver; the sample's hashed features are gathered, never its texts. Scoring is a
pass over Arrow batches; a model holds the weights of the features of its bounded sample, whatever the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CACHE_WORDS = 400_000
MOST_GRADES = 64
_LETTERS = re.compile(r"[^\W\d_]+")

#: Feature names of a text with their values.
Features = Callable[[str], dict[str, float]]


def bucket(name: str) -> int:
    """A feature's place in a space of 2^32, of which a model holds the places it uses."""
    return zlib.crc32(name.encode("utf-8", "surrogatepass"))


def word_parts(word: str) -> tuple[str, ...]:
    """A word, and the stems that compounds and inflections share with it."""
    return (word, *(word[:n] + "-" for n in range(4, 8) if n < len(word)))


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    thresholds: np.ndarray

    def tail(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row a score."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -40, 40)
        return 1 / (1 + np.exp(-z))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, weight: np.ndarray | None = None, l2: float = 1e-4, steps: int = 150, rate: float = 0.05) -> Model:
    """rows: (indices, values) each; weight: how many rows a row stands for. Maximum likelihood with an L2 term, by Adam over all rows."""
    idx = np.concatenate([r[0] for r in rows]).astype(np.int64)
    val = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    used, idx = np.unique(idx, return_inverse=True)
    weight = np.ones(len(rows)) if weight is None else weight
    weight = weight / weight.sum()
    # Thresholds as a first value and log-gaps, so they stay ordered.
    par = np.zeros(len(used) + n_grades - 1)
    m, v = np.zeros_like(par), np.zeros_like(par)
    for t in range(1, steps + 1):
        w, a = par[: len(used)], par[len(used) :]
        th = a[0] + np.concatenate([[0.0], np.cumsum(np.exp(a[1:]))])
        s = np.bincount(row, val * w[idx], minlength=len(rows))
        up = np.concatenate([th, [np.inf]])[grades]
        lo = np.concatenate([[-np.inf], th])[grades]
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        pu, pl = np.where(np.isinf(up), 1.0, sig(up - s)), np.where(np.isinf(lo), 0.0, sig(lo - s))
        p = np.maximum(pu - pl, 1e-12)
        du, dl = pu * (1 - pu), pl * (1 - pl)
        ds = weight * (du - dl) / p  # d(-log p) / ds
        gth = np.zeros(n_grades - 1)
        np.add.at(gth, grades[grades < n_grades - 1], -(weight * du / p)[grades < n_grades - 1])
        np.add.at(gth, grades[grades > 0] - 1, (weight * dl / p)[grades > 0])
        ga = np.empty(n_grades - 1)
        ga[0] = gth.sum()
        for k in range(1, n_grades - 1):
            ga[k] = gth[k:].sum() * np.exp(a[k])
        g = np.concatenate([np.bincount(idx, val * ds[row], minlength=len(used)) + l2 * w, ga])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    a = par[len(used) :]
    return Model(dict(zip(used.tolist(), par[: len(used)].round(6).tolist())), a[0] + np.concatenate([[0.0], np.cumsum(np.exp(a[1:]))]))


def rated_once(ratings: DataFrame, grade: str) -> DataFrame:
    """doc_id, grade: each rated document once, by its largest grade."""
    return ratings.where(f"doc_id is not null and {grade} is not null").groupBy("doc_id").agg(F.max(grade).cast("int").alias("grade"))


def grade_counts(ratings: DataFrame, grade: str) -> dict[int, int]:
    """Rated documents of each grade. A scale has MOST_GRADES grades at most; more are an error."""
    n = {int(r[0]): int(r[1]) for r in rated_once(ratings, grade).groupBy("grade").count().limit(MOST_GRADES + 1).collect()}
    if len(n) > MOST_GRADES or min(n, default=0) < 0:
        raise ValueError(f"grades must be whole numbers from 0 on, at most {MOST_GRADES} of them")
    return n


def highest_hash(count: int, sample: int) -> int:
    """A bound on the hash below which `sample` of `count` ids lie, but for a chance of eight deviations; about `sample`
    more of them do at most, whatever the count."""
    share = min(1.0, (sample + 8 * sample**0.5 + 64) / max(1, count))
    return min(2**63 - 1, int(share * 2**64) - 2**63)


def sample_rows(docs: DataFrame, ratings: DataFrame, grade: str, sample: int, counts: dict[int, int] | None = None) -> DataFrame:
    """Up to `sample` rated rows of each grade with their texts, those of the lowest hashes: doc_id, text, grade. counts:
    grade_counts(ratings), counted here if not given. A bound on the hash, from a grade's count, leaves little more than the sample to be ranked, so
    a grade of any size meets in no task. The ids are at most MOST_GRADES times `sample`, so they may be broadcast."""
    counts = grade_counts(ratings, grade) if counts is None else counts
    most = F.create_map(*[F.lit(x).cast(t) for g, n in (counts or {0: 0}).items() for x, t in ((g, "int"), (highest_hash(n, sample), "long"))])
    w = Window.partitionBy("grade").orderBy("_hash", "doc_id")
    low = rated_once(ratings, grade).withColumn("_hash", F.xxhash64("doc_id")).where(F.col("_hash") <= most[F.col("grade")])
    some = low.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= sample).drop("_place", "_hash")
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def stands_for(counts: dict[int, int], sample: int, rated: np.ndarray) -> np.ndarray:
    """How many rated documents each row of a sample stands for, by its grade: the fit sees the grades' true shares."""
    return np.array([counts[g] / min(counts[g], sample) for g in rated.tolist()])


def hashed(features: Features, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    acc: Counter[int] = Counter()
    for name, v in features(text or "").items():
        acc[bucket(name)] += v
    return np.fromiter(acc.keys(), np.int64, len(acc)), np.fromiter(acc.values(), np.float32, len(acc))


def gather(rows: DataFrame, features: Features) -> list[tuple[int, np.ndarray, np.ndarray, int]]:
    """(doc_id, indices, values, grade) of the sample, sorted by id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            xs = [hashed(features, t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "idx": [x[0].astype(np.uint32).tobytes() for x in xs], "val": [x[1].tobytes() for x in xs], "grade": pdf["grade"]})

    got = rows.mapInPandas(run, "doc_id long, idx binary, val binary, grade int").toPandas().sort_values("doc_id")
    out = []
    for d, i, v, g in zip(got["doc_id"], got["idx"], got["val"], got["grade"]):
        ix, vx = np.frombuffer(i, np.uint32), np.frombuffer(v, np.float32)
        order = np.argsort(ix)  # the sums of the fit do not depend on the order of batches
        out.append((int(d), ix[order], vx[order], int(g)))
    return out
