"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The windows of all items (``n`` consecutive words; a shorter item is one
window of its own length) are hashed into a sorted array, which is broadcast.
A scan hashes the windows of each document, looks them up, and confirms each
hit by the words themselves.  Words inside an occurrence are hit; they can be
cut out of the text, or the document dropped.

What is broadcast is bounded, and so is what holds it (a block of 16 MB of text
takes some 150 MB in the driver and in each worker): items go to ``ceil(bytes / max_bytes)`` blocks by
a hash, and the documents are scanned once per block, each scan adding to the
hits so far (written out between scans).  One block, the usual case, needs no
shuffle and no write.

Words are longest runs of ASCII letters and digits and of all characters beyond
ASCII, after lower-casing A-Z.  Null and empty texts have no words and no hits.
Items without words take no part; items with equal windows are all reported;
repeated items count once.  Passages of items without an item_id are hit and cut
like others, but there is no id to report: ``n_items`` and ``items_sha256`` leave
them out.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin
from .common import ALNUM, window_hashes, word_hashes


@dataclass(frozen=True)
class DecontaminationParams:
    n: int = 10
    max_bytes: int = 16 << 20   # of item text in one broadcast


_HITS = "n_words long, spans array<int>, items array<string>"


def words_of(text: str | None):
    """Lower-cased bytes of the text; hashes, starts and ends of its words."""
    data = (text or "").encode("utf-8", "replace").lower()
    return data, *word_hashes(data, ALNUM)


class WindowIndex:
    """Windows of the items: sorted hashes with the place of each window's words
    in the items' normalised text, and its item.  About 20 bytes for a window
    besides the text, the same again while it is made."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        texts, hashes, begins, ends, owners = [], [], [], [], []
        at, self.sizes, self.items = 0, set(), [item for item, _ in items]
        for number, (_, text) in enumerate(items):
            data, h, start, end = words_of(text)
            k = min(n, len(h))
            if not k:
                continue
            self.sizes.add(k)
            clean = b" ".join(data[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True))
            size = end - start
            place = at + np.concatenate(([0], np.cumsum(size + 1)[:-1]))
            hashes.append(window_hashes(h, k))
            begins.append(place[:len(h) - k + 1])
            ends.append((place + size)[k - 1:])
            owners.append(np.full(len(h) - k + 1, number, np.int32))
            texts.append(clean)
            at += len(clean)
        self.text = b"".join(texts)
        joined = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        self.hashes = joined(hashes, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.begins, self.ends, self.owners = (joined(x, np.uint32)[order] for x in (begins, ends, owners))
        bits = min(26, max(20, len(order).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.near = np.zeros(1 << bits, bool)
        self.near[self.hashes >> self.shift] = True

    @staticmethod
    def normal(data: bytes, start, end) -> bytes:
        return b" ".join(data[i:j] for i, j in zip(start, end, strict=True))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit word ranges (merged, half-open), ids of the items found."""
        data, h, start, end = words_of(text)
        ranges, items = [], set()
        for k in self.sizes:
            w = window_hashes(h, k)
            at = np.flatnonzero(self.near[w >> self.shift])
            first = np.searchsorted(self.hashes, w[at])
            last = np.searchsorted(self.hashes, w[at], "right")
            for i, lo, hi in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                if lo == hi:
                    continue
                words = self.normal(data, start[i:i + k], end[i:i + k])
                same = [m for m in range(lo, hi) if self.text[self.begins[m]:self.ends[m]] == words]
                if same:
                    ranges.append((i, i + k))
                    items.update(self.items[self.owners[m]] for m in same)
        return len(h), merged(ranges), items - {None}


def merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for i, j in sorted(ranges):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return [(i, j) for i, j in out]


def _blocks(benchmark: DataFrame, p: DecontaminationParams):
    """Item lists of bounded size, each fetched when it is asked for."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
             .filter("text is not null and text <> ''"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first().b
    n = max(1, -(-size // p.max_bytes))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).dropDuplicates().collect()
        yield n, [(r["item"], r["text"]) for r in rows]


def _scan(spark, index: WindowIndex, before: bool) -> Column:
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(_HITS)
    def scan(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.scan(t) for t in texts]
        return pd.DataFrame({"n_words": [x[0] for x in found], "spans": [np.array(x[1], np.int32).ravel() for x in found],
                             "items": [sorted(x[2]) for x in found]})

    @F.pandas_udf(_HITS)
    def scan_on(texts: pd.Series, so_far: pd.DataFrame) -> pd.DataFrame:
        found = [shared.value.scan(t) for t in texts]
        spans = [merged([*x[1], *map(tuple, np.array(s, int).reshape(-1, 2).tolist())]) for x, s in zip(found, so_far["spans"], strict=True)]
        return pd.DataFrame({"n_words": [x[0] for x in found], "spans": [np.array(s, np.int32).ravel() for s in spans],
                             "items": [sorted(x[2] | set(i)) for x, i in zip(found, so_far["items"], strict=True)]})

    return scan_on(F.col("row.text"), F.col("hit")) if before else scan(F.col("row.text"))


def find_hits(documents: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """(row: the document, hit: n_words, spans, items) of every row; ``spans``
    holds begin and end of each hit range of words, ``items`` the sorted ids."""
    out, held = documents.select(F.struct("*").alias("row")), None
    for k, (n, items) in enumerate(_blocks(benchmark, params)):
        out = out.select("row", _scan(documents.sparkSession, WindowIndex(items, params.n), k > 0).alias("hit"))
        if k + 1 < n:
            out = pin(out, "decontaminate")
            if held is not None:
                unpin(held)
            held = out
    return out


def _n_hit() -> Column:
    """Ends less begins of the hit ranges."""
    return F.aggregate(F.transform("hit.spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)


def report(documents: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    return (find_hits(documents.select("doc_id", "text"), benchmark, params)
            .select(F.col("row.doc_id").alias("doc_id"), F.col("hit.n_words").alias("n_words"), _n_hit().alias("n_hit"),
                    F.size("hit.items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "hit.items"), 256).alias("items_sha256"), (F.size("hit.spans") > 0).alias("contaminated")))


def cut_spans(text: str, spans) -> str:
    """The text without the hit words and what lies between them."""
    data = text.encode("utf-8", "replace")
    _, _, start, end = words_of(text)
    out, at = [], 0
    for i, j in np.array(spans, int).reshape(-1, 2):
        out.append(data[at:start[i]])
        at = int(end[j - 1])
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def clean(documents: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams(),
          max_hit_share: float = 1.0) -> DataFrame:
    """``documents`` with every hit span cut out of its text; documents with
    more than ``max_hit_share`` of their words hit are dropped.  Columns
    unchanged (``n_chars``, if there is one, follows the new text)."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        # A Python function runs for every row, whatever the condition around it.
        return pd.Series([None if t is None else cut_spans(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    found = find_hits(documents, benchmark, params)
    if max_hit_share < 1:
        found = found.filter(_n_hit() <= max_hit_share * F.col("hit.n_words"))
    found = found.select("row", F.when(F.size("hit.spans") > 0, cut(F.col("row.text"), F.col("hit.spans"))).alias("cut"))
    kinds = dict(documents.dtypes)
    new = {"text": F.coalesce("cut", "row.text")}
    if "n_chars" in kinds:
        new["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("cut")).otherwise(F.col("row.n_chars")).cast(kinds["n_chars"])
    return found.select([new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])


def sha256_of(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
