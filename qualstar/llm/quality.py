"""Quality: regularised quadratic discriminant over document statistics.

Each whole text becomes a short vector of transformed statistics (shares go
through arcsine of the root, sizes through log).  Class sums and sums of outer
products over all labelled training rows are added up in Spark, one small row
per task and class; the driver turns them into means and covariances, shrunk
towards the pooled covariance and its diagonal, and factors them once
(Cholesky).  A score is the logistic of the two classes' log-density
difference (half Mahalanobis distances and log determinants, from the cached
factors) plus the log prior ratio, divided by a temperature.

The vectors are written once and joined with the labels without the texts.
Null and empty texts have the statistics of an empty text.  If either class
has no labelled row every score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import NON_SPACE, fold_of, window_hashes, word_hashes


@dataclass(frozen=True)
class QualityParams:
    to_pooled: float = 0.1      # weight of the pooled covariance in each class's own
    to_diagonal: float = 0.05   # weight of its own diagonal after that
    floor: float = 1e-4         # least variance of a statistic
    temperature: float = 2.0
    folds: int = 5              # ids with crc32 mod folds = 0 are never learnt from
    threshold: float = 0.3


_KINDS = ("lower", "upper", "digit", "stop", "exclaim", "quote", "dash", "symbol", "pipe", "other")


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 0x80:
        return 9
    for k, chars in ((3, ".,;:?"), (4, "!"), (5, "\"'()"), (6, "-_"), (8, "|")):
        if c in chars:
            return k
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    return -1 if c.isspace() or b < 0x20 or b == 0x7F else 7


_OF_KIND = np.array([[_kind(b) == k for k in range(len(_KINDS))] for b in range(256)], float)
N_STATS = len(_KINDS) + 10


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one text (N_STATS numbers, all finite)."""
    data = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    marks = counts @ _OF_KIND
    visible = max(1.0, marks.sum())
    words, start, end = word_hashes(data, NON_SPACE)
    n = len(words)
    size = end - start
    _, times = np.unique(words, return_counts=True)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    runs = window_hashes(words, 3)
    shares = [
        len(times) / n if n else 1.0,
        times.max() / n if n else 0.0,
        len(np.unique(runs)) / len(runs) if len(runs) else 1.0,
        len(set(lines)) / len(lines) if lines else 1.0,
        (size <= 2).sum() / n if n else 0.0,
        (size >= 14).sum() / n if n else 0.0,
    ]
    sizes = [n, size.mean() if n else 0.0, size.std() if n else 0.0, n / max(1, len(lines))]
    return np.concatenate((np.arcsin(np.sqrt(np.clip(np.concatenate((marks / visible, shares)), 0, 1))), np.log1p(sizes)))


@dataclass
class QualityModel:
    means: np.ndarray      # per class
    factors: np.ndarray    # per class: inverse of the Cholesky factor
    log_dets: np.ndarray
    log_prior: float       # of class 1 over class 0
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(1) - 0.5 * d
                   for m, f, d in zip(self.means, self.factors, self.log_dets, strict=True)]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0] + self.log_prior) / self.temperature, -500, 500)))


@dataclass
class ConstantModel:
    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, stats: N_STATS doubles packed little-endian) of every row."""
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t).astype("<f8").tobytes() for t in texts], dtype=object)

    return documents.select("doc_id", packed("text").alias("stats"))


def _matrix(stats) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, stats)), "<f8").reshape(-1, N_STATS)


def fit(labelled: DataFrame, params: QualityParams = QualityParams()) -> QualityModel | ConstantModel:
    """Fit on all rows of ``labelled(stats, label)``, label 0 or 1."""
    def sums(batches):
        total = {}
        for pdf in batches:
            for c, part in pdf.groupby("label"):
                x = _matrix(part.stats)
                one = np.hstack((np.ones((len(x), 1)), x))
                total[c] = total.get(c, 0) + one.T @ one
        yield pd.DataFrame([(c, i, j, m[i, j]) for c, m in total.items() for i in range(len(m)) for j in range(i + 1)],
                           columns=["label", "i", "j", "v"])

    rows = (labelled.mapInPandas(sums, "label int, i int, j int, v double")
            .groupBy("label", "i", "j").agg(F.sum("v").alias("v")).collect())   # a fixed number of sums
    moments = {c: np.zeros((N_STATS + 1,) * 2) for c in (0, 1)}
    for r in rows:
        moments[r.label][r.i, r.j] = moments[r.label][r.j, r.i] = r.v
    n = {c: m[0, 0] for c, m in moments.items()}
    if not (n[0] and n[1]):
        return ConstantModel(n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.0)
    means = {c: m[0, 1:] / n[c] for c, m in moments.items()}
    own = {c: m[1:, 1:] / n[c] - np.outer(means[c], means[c]) for c, m in moments.items()}
    pooled = (own[0] * n[0] + own[1] * n[1]) / (n[0] + n[1])
    factors, dets = [], []
    for c in (0, 1):
        s = (1 - params.to_pooled) * own[c] + params.to_pooled * pooled
        s = (1 - params.to_diagonal) * s + params.to_diagonal * np.diag(np.diag(s)) + params.floor * np.eye(N_STATS)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        dets.append(2 * np.log(np.diag(low)).sum())
    return QualityModel(np.array([means[0], means[1]]), np.array(factors), np.array(dets),
                        float(np.log(n[1] / n[0])), params.temperature)


def score(spark, model) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(stats: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(_matrix(stats)) if len(stats) else [], dtype=float)

    return scored(F.col("stats"))


def classify(documents: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``.  A
    document with several labels has the largest; of rows that share an id, one
    (of the smallest statistics) is learnt from, so that copies weigh nothing."""
    stats = pin(document_statistics(documents), "quality-stats")
    marked = (labels.filter(fold_of("doc_id", params.folds) != 0).groupBy("doc_id").agg(F.max("quality").alias("label"))
              .filter(F.col("label").isin(0, 1)))
    once = stats.join(marked, "doc_id").groupBy("doc_id", "label").agg(F.min("stats").alias("stats"))
    model = fit(once.select("stats", "label"), params)
    return (stats.select("doc_id", score(stats.sparkSession, model).alias("score"))
            .select("doc_id", F.coalesce(fold_of("doc_id", params.folds) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= params.threshold).cast("int").alias("predicted")))
