"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent in numpy.

A text is the bag of its byte n-grams (lower case; digits, ASCII punctuation
and white space count as one blank); each n-gram is hashed to a row of an
embedding table, the rows are averaged and a linear softmax follows.  The fit
reads a bounded sample of the labelled rows (``max_rows`` in all, evenly by
language, by id hash; of rows that share an id the smallest language and text
count) on the driver.  A tenth of the sample is kept apart to fit a
temperature, so that scores are calibrated, and the score below which a
prediction is ``rejected``.

For scoring, table times softmax weights is one small matrix with a row per
hash; a text's logits are the mean of its n-grams' rows.  One scan, no shuffle,
whole texts.  Null texts and texts without a letter get ``und`` with score 0,
as do all texts if nothing is labelled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin
from .common import byte_grams, fold_of, stratified_ids

_CHUNK = 1 << 20


@dataclass(frozen=True)
class LanguageParams:
    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 15               # the embedding table has 2**bits rows
    dim: int = 16
    max_rows: int = 4000         # bound of the training sample
    epochs: int = 6
    rate: float = 0.5
    kept_apart: float = 0.1      # of the sample, for calibration
    least_precision: float = 0.99
    folds: int = 4               # ids with crc32 mod folds = held_fold are never learnt from
    held_fold: int = 2


_BLANK = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _buckets(text: str, p: LanguageParams):
    """Hash rows of the n-grams, chunk by chunk."""
    data = b" " + text.lower().encode("utf-8", "replace").translate(_BLANK) + b" "
    step = max(p.orders) - 1
    shift = np.uint64(64 - p.bits)
    for at in range(0, len(data), _CHUNK):
        end = at + _CHUNK
        for n, g in zip(p.orders, byte_grams(data[at:end + step], p.orders), strict=True):
            with np.errstate(over="ignore"):
                # A chunk owns the n-grams that begin in it.
                yield ((g[:_CHUNK] * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray            # hash row x language: embedding times softmax weights
    temperature: float
    reject_below: float
    params: LanguageParams

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.langs)), 0
        for rows in _buckets(text, self.params):
            total += self.table[rows].sum(0, dtype=np.float64)
            n += len(rows)
        return total / max(1, n)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        z = self.logits(text) * self.temperature
        e = np.exp(z - z.max())
        best = int(e.argmax())
        return self.langs[best], float(e[best] / e.sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, langs: list[str], p: LanguageParams) -> LanguageModel:
    """``bags``: hash rows (distinct) and their shares, a pair per text."""
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 1 / p.dim, (1 << p.bits, p.dim)).astype(np.float32)
    out = np.zeros((p.dim, len(langs)), np.float32)
    apart = np.zeros(len(bags), bool)
    apart[rng.permutation(len(bags))[:int(len(bags) * p.kept_apart)]] = len(bags) >= 20
    learn = np.flatnonzero(~apart)
    for epoch in range(p.epochs):
        rate = p.rate * (1 - epoch / p.epochs)
        for i in rng.permutation(learn):
            rows, share = bags[i]
            h = share @ emb[rows]
            err = _softmax(h @ out)
            err[y[i]] -= 1
            back = out @ err
            out -= rate * np.outer(h, err)
            # An averaged row's gradient is its share of the text; scaled up so that rows learn as fast as weights.
            emb[rows] -= rate * np.outer(share * len(rows) ** 0.5, back)
    model = LanguageModel(langs, (emb @ out).astype(np.float32), 1.0, 0.0, p)
    test = np.flatnonzero(apart) if apart.any() else learn
    z = np.array([bags[i][1] @ model.table[bags[i][0]] for i in test])
    scales = 2.0 ** np.arange(-3, 8, 0.25)
    # Smoothed targets: without them a sample without a mistake has no best temperature.
    target = np.full(z.shape, 1 / (len(test) + len(langs)))
    target[np.arange(len(test)), y[test]] += len(test) / (len(test) + len(langs))
    loss = [-(target * np.log(np.maximum(_softmax(z * s), 1e-300))).sum(1).mean() for s in scales]
    model.temperature = float(scales[int(np.argmin(loss))])
    prob = _softmax(z * model.temperature)
    right, sure = prob.argmax(1) == y[test], prob.max(1)
    order = np.argsort(-sure)
    good = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= p.least_precision)
    model.reject_below = float(sure[order[good[-1]]]) if len(good) else 1.0
    return model


def train(documents: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    p = params
    labelled = pin(documents.filter((fold_of("doc_id", p.folds) != p.held_fold) & F.col("text").isNotNull())
                   .groupBy("doc_id").agg(F.min("lang").alias("label")).filter("label is not null"), "language-labels")
    langs = sorted(r.label for r in labelled.select("label").distinct().limit(p.max_rows).collect())
    if not langs:
        return LanguageModel([], np.zeros((1 << p.bits, 0), np.float32), 1.0, 1.0, p)
    ids = pin(stratified_ids(labelled, max(1, p.max_rows // len(langs))), "language-ids")

    def bags(batches):
        for pdf in batches:
            pdf = pdf[[has_letter(t) for t in pdf.text]]
            found = [np.unique(np.concatenate(list(_buckets(t, p))), return_counts=True) for t in pdf.text]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "label": pdf.label,
                                "rows": [r.astype(np.int32).tobytes() for r, _ in found],
                                "share": [(c / c.sum()).astype(np.float32).tobytes() for _, c in found]})

    # ids holds at most max_rows rows, each with one text here; a bag holds at most 2**bits entries.
    got = (documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
           .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
           .mapInPandas(bags, "doc_id long, label string, rows binary, share binary").toPandas()
           .sort_values("doc_id", kind="stable"))
    unpin(labelled, ids)
    if not len(got):
        return LanguageModel([], np.zeros((1 << p.bits, 0), np.float32), 1.0, 1.0, p)
    langs = sorted(set(got.label))
    y = np.array([langs.index(x) for x in got.label])
    return fit([(np.frombuffer(r, np.int32), np.frombuffer(s, np.float32)) for r, s in zip(got.rows, got.share, strict=True)], y, langs, p)


def predict(documents: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """Column of (lang string, score double)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return predicted(F.col(text))


def identify(documents: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row: ``rejected``
    marks ``und`` and predictions less sure than the calibrated bound."""
    model = train(documents, params)
    held = F.coalesce(fold_of("doc_id", params.folds) == params.held_fold, F.lit(False))
    return (documents.select("doc_id", predict(documents, model).alias("p"))
            .select("doc_id", held.alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                    ((F.col("p.lang") == "und") | (F.col("p.score") < model.reject_below)).alias("rejected")))
