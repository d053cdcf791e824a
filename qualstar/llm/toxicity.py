"""Toxicity: a linear classifier on character n-grams whose features are scaled
by naive Bayes log-count ratios.

Training reads a bounded sample of the labelled rows (``per_class`` of either
label, by id hash; of texts that share an id the smallest is learnt from, so
repeated rows don't enlarge it).  Each document is the set of its n-grams.  Log-count ratios
come from distributed counts over the sample; n-grams whose classes don't
differ by ``min_z`` standard errors are left out, so that neither long clean
texts nor rare n-grams add noise.  A regularised logistic regression over the
scaled features is then fitted on the driver (sample x kept n-grams, bounded by
the two parameters).  N-grams are runs of code points, so a character of any
script counts as one and is never cut apart; they are known by 64-bit hashes.

Scoring is one scan, without a shuffle; whole texts are read.  Null and empty
texts score as a document without features.  Without labels of both classes
every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin
from .common import char_grams, fold_of, stratified_ids

_CHUNK = 1 << 22


@dataclass(frozen=True)
class ToxicityParams:
    orders: tuple[int, ...] = (4, 5, 6)
    per_class: int = 2000       # bound of the training sample, rows of each label
    max_features: int = 10000   # bound of the model
    min_docs: int = 3
    min_z: float = 4.0
    l2: float = 1e-3
    folds: int = 5              # ids with crc32 mod folds = 0 are never learnt from
    threshold: float = 0.5


@dataclass
class ToxicityModel:
    grams: np.ndarray    # sorted hashes of n-grams
    weights: np.ndarray  # log-count ratio times fitted weight
    bias: float
    params: ToxicityParams

    def __post_init__(self):
        self.near = np.zeros(1 << 16, bool)
        self.near[_bucket(self.grams)] = True

    def found(self, text: str | None) -> np.ndarray:
        """Positions in ``grams`` of the distinct n-grams of the text."""
        data, hits = _prepared(text), []
        step = max(self.params.orders) - 1
        for at in range(0, len(data), _CHUNK):
            for g in char_grams(data[at:at + _CHUNK + step], self.params.orders):
                hits.append(g[self.near[_bucket(g)]])
        g = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.uint64)
        at = np.searchsorted(self.grams, g)
        at[at == len(self.grams)] = 0
        return at[self.grams[at] == g] if len(self.grams) else at[:0]

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[self.found(text)].sum() + self.bias, -500, 500))))


def _bucket(grams: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


def _prepared(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text, white space made one blank."""
    if not text:
        return np.empty(0, np.uint32)
    return np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), "<u4")


def _gram_counts(sample: DataFrame, p: ToxicityParams) -> DataFrame:
    """(gram, toxic documents, other documents), combined per task first."""
    def count(batches):
        for pdf in batches:
            seen = [[np.unique(np.concatenate(list(char_grams(d, p.orders)))) for d in map(_prepared, pdf.text[pdf.label == c]) if len(d)]
                    for c in (0, 1)]
            both = [np.unique(np.concatenate(s), return_counts=True) if s else (np.empty(0, np.uint64), np.empty(0, int))
                    for s in seen]
            yield pd.DataFrame({"gram": np.concatenate([x[0] for x in both]).view(np.int64),
                                "pos": np.concatenate([0 * both[0][1], both[1][1]]),
                                "neg": np.concatenate([both[0][1], 0 * both[1][1]])})

    return (sample.mapInPandas(count, "gram long, pos long, neg long")
            .groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _fit_weights(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Logistic regression over ratio-scaled binary features, by accelerated
    full gradient steps with a fixed step size."""
    w, b = np.zeros(len(ratio)), 0.0
    at = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    col = np.concatenate(rows)
    val, n = ratio[col], len(rows)
    share = np.where(y == 1, n / (2 * max(1, y.sum())), n / (2 * max(1, n - y.sum()))) / n
    lip = 0.25 * max(1.0, float((np.bincount(at, val * val, n) + 1).max())) + l2
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(400):
        z = np.bincount(at, val * vw[col], n) + vb
        g = share * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        nw = vw - (np.bincount(col, val * g[at], len(w)) + l2 * vw) / lip
        nb = vb - g.sum() / lip
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def train(documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on ``labels(doc_id, toxic)`` and the texts of ``documents``.  A
    document with several labels is toxic if any says so."""
    p = params
    marked = pin(labels.filter(fold_of("doc_id", p.folds) != 0)
                 .groupBy("doc_id").agg(F.max("toxic").alias("label")), "toxicity-labels")
    ids = pin(stratified_ids(marked, p.per_class), "toxicity-ids")
    # The ids are bounded by per_class, so the texts are filtered by broadcast; an id has one text, however many rows bear it.
    sample = pin(documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
                 .groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxicity-sample")
    n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    empty = ToxicityModel(np.empty(0, np.uint64), np.empty(0), -500.0, p)
    if not (n.get(0) and n.get(1)):
        unpin(marked, ids, sample)
        return empty
    n1, n0 = n[1], n[0]
    p1, p0 = (F.col("pos") + 1) / (n1 + 2), (F.col("neg") + 1) / (n0 + 2)
    z = F.abs(p1 - p0) / F.sqrt(p1 * (1 - p1) / n1 + p0 * (1 - p0) / n0)
    kept = (_gram_counts(sample, p).filter(F.col("pos") + F.col("neg") >= p.min_docs)
            .select("gram", F.log(p1 / p0).alias("ratio"), z.alias("z")).filter(F.col("z") >= p.min_z)
            .orderBy(F.desc("z"), "gram").limit(p.max_features).toPandas())
    if not len(kept):
        unpin(marked, ids, sample)
        return empty
    grams = kept.gram.to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    draft = ToxicityModel(grams[order], kept.ratio.to_numpy(float)[order], 0.0, p)
    shared = sample.sparkSession.sparkContext.broadcast(draft)

    def features(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "label": pdf.label,
                                "found": [shared.value.found(t).astype(np.int32).tobytes() for t in pdf.text]})

    got = sample.mapInPandas(features, "doc_id long, label int, found binary").toPandas()
    unpin(marked, ids, sample)
    got = got.sort_values(["doc_id", "label"], kind="stable")
    rows = [np.frombuffer(x, np.int32) for x in got.found]
    w, b = _fit_weights(rows, got.label.to_numpy(float), draft.weights, p.l2)
    return ToxicityModel(draft.grams, draft.weights * w, b, p)


def score(documents: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Column of scores (0 to 1) for the text column."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return scored(F.col(text))


def classify(documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``."""
    model = train(documents, labels, params)
    return (documents.select("doc_id", score(documents, model).alias("score"))
            .select("doc_id", F.coalesce(fold_of("doc_id", params.folds) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= params.threshold).cast("int").alias("predicted")))


def reject(documents: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``documents`` without the rows classified as toxic; columns unchanged."""
    model = train(documents, labels, params)
    return documents.filter(score(documents, model) < params.threshold)
