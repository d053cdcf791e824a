"""Collocations: frequent phrases of two to five words that stand together more
often than their parts would by chance, per language.

Level by level: an occurrence of k words is a pair of neighbouring occurrences
of k - 1 words, and it counts only if both of them are frequent units of the
level below (a frequent phrase has frequent parts only).  Frequent pairs are
the units of the next level and ranked anew by frequency.

Within a task, pairs are counted chunk by chunk.  The ``hot`` most frequent
units have their rank as a direct address: a pair of ranks falls into a tile of
``side`` x ``side`` cells; a tile with enough hits is counted by one dense
bincount, the pairs of all other tiles as sorted coordinates with their counts,
and so are pairs with a unit beyond the hot ones, by hash.  Spark adds up the
counts of all chunks.

What is broadcast has a bound whatever the corpus: the hot units, and a bitmap
of at most 2 ** ``most_bits`` bits that tells which hashes may be frequent
units.  A bit that several units share lets pairs through that fall to the
threshold later; it never changes a count.  Words and phrases are known by
64-bit hashes of language and words between the levels (words themselves are
counted as text).

Texts are cut into chunks at white space and punctuation with as many words of
context as a phrase needs, so long ones need no more memory and lose nothing
(a single word is never cut).  A null text has no words, a null lang is
``und``.  Repeated rows count each time.  Other columns take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin, unpin
from .common import _splitmix, word_hashes


@dataclass(frozen=True)
class PhraseParams:
    least: int = 100          # occurrences of a candidate
    longest: int = 5          # words
    top: int = 2000           # of a language
    hot: int = 16384          # units with a direct address
    side: int = 512           # of a tile
    dense: int = 16           # a tile with a hit for every so many cells is dense
    chunk_bytes: int = 2 << 20
    most_bits: int = 27


_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = np.array([b in _BREAKS for b in range(256)])
_WORD = np.array([b not in _BREAKS + b" \t" for b in range(256)])
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SEPARATOR = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_CONTEXT = {k: re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]+[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % k) for k in range(16)}


# --- hashes -------------------------------------------------------------------

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _xx(x: np.ndarray, seed) -> np.ndarray:
    h = _turn((seed + _P5 + np.uint64(8)) ^ (_turn(x * _P2, 31) * _P1), 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 makes of two longs."""
    with np.errstate(over="ignore"):
        return _xx(b, _xx(a, np.uint64(42)))


def _language_seed(lang: str) -> np.uint64:
    return np.uint64(int(word_hashes(lang.encode(), np.ones(256, bool))[0][0]) if lang else 0)


# --- words of a chunk -----------------------------------------------------------

def segments(data: bytes, size: int, context: int) -> Iterator[tuple[bytes, int]]:
    """Parts of about ``size`` bytes, each with ``context`` words beyond it and
    the place before which its own words begin."""
    at = 0
    while len(data) - at > size and (found := _SEPARATOR.search(data, at + size)):
        cut = found.start()
        yield data[at:_CONTEXT[context].match(data, cut).end()], cut - at
        at = cut
    yield data[at:], len(data) - at


def chunks(batches: Iterator[pa.RecordBatch], size: int, context: int) -> Iterator[tuple[str, bytes, int]]:
    """(lang, text, place before which words count) of the rows (lang, text)."""
    held: dict[str, list[bytes]] = {}
    weight: dict[str, int] = {}

    def flush(lang: str) -> Iterator[tuple[str, bytes, int]]:
        weight.pop(lang)
        for part, own in segments(b"\n".join(held.pop(lang)), size, context):
            yield lang, part.translate(_LOWER), own

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if text:
                held.setdefault(lang, []).append(text)
                weight[lang] = weight.get(lang, 0) + len(text)
                if weight[lang] >= size:
                    yield from flush(lang)
        while sum(weight.values()) > 8 * size:       # many languages
            yield from flush(max(weight, key=weight.get))
    for lang in list(held):
        yield from flush(lang)


@dataclass
class Words:
    units: np.ndarray        # hash of language and word
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray        # number of the piece that a word is in


def words_of(lang: str, data: bytes) -> Words:
    h, start, end = word_hashes(data, _WORD)
    with np.errstate(over="ignore"):
        units = _splitmix(h ^ _splitmix(np.array([_language_seed(lang)]) + np.uint64(len(lang) + 1)))
    return Words(units, start, end, np.cumsum(_BREAK[np.frombuffer(data, np.uint8)], dtype=np.int32)[start])


def _strings(data: bytes, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words from start to end as an Arrow column, without a Python object each."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    text = np.frombuffer(data, np.uint8)[at]
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)]).cast(pa.string())


# --- pairs of units ---------------------------------------------------------------

class Units:
    """The frequent units of a level: which hashes may be one, and the ranks of the hot."""

    def __init__(self, bits: np.ndarray, hot: np.ndarray):
        self.bits, self.by_rank = bits, hot
        self.order = np.argsort(hot)
        self.sorted = hot[self.order]

    def may_be(self, u: np.ndarray) -> np.ndarray:
        at = u & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def rank(self, u: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(u), -1)
        at = np.minimum(np.searchsorted(self.sorted, u), len(self.sorted) - 1)
        return np.where(self.sorted[at] == u, self.order[at], -1)


def count_pairs(a: np.ndarray, b: np.ndarray, units: Units, p: PhraseParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (a, b) and their numbers."""
    x, y = units.rank(a), units.rank(b)
    hot = (x >= 0) & (y >= 0)
    out = []
    x, y = x[hot], y[hot]
    across = -(-max(1, len(units.by_rank)) // p.side)
    tile = (x // p.side) * across + y // p.side
    hits = np.bincount(tile, minlength=across * across)
    dense = hits * p.dense >= p.side * p.side
    if dense.any():
        order = np.argsort(tile, kind="stable")
        ends = np.cumsum(hits)
        for t in np.flatnonzero(dense):
            own = order[ends[t] - hits[t]:ends[t]]
            cells = np.bincount((x[own] % p.side) * p.side + y[own] % p.side, minlength=p.side * p.side)
            at = np.flatnonzero(cells)
            out.append((units.by_rank[t // across * p.side + at // p.side], units.by_rank[t % across * p.side + at % p.side], cells[at]))
    rest = ~dense[tile]
    cell, n = np.unique(x[rest] * len(units.by_rank) + y[rest], return_counts=True)
    if len(cell):
        out.append((units.by_rank[cell // len(units.by_rank)], units.by_rank[cell % len(units.by_rank)], n))
    a, b = a[~hot], b[~hot]
    _, first, n = np.unique(pair_hash(a, b), return_index=True, return_counts=True)
    out.append((a[first], b[first], n))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def pairs_of(words: Words, own: int, k: int, units: Units, p: PhraseParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the chunk's phrases of ``k`` words as pairs of units of k - 1."""
    m = len(words.units) - k + 1
    if m <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),)
    u = words.units
    for _ in range(k - 2):
        u = pair_hash(u[:-1], u[1:])
    may = units.may_be(u)
    at = np.flatnonzero(may[:m] & may[1:m + 1] & (words.piece[:m] == words.piece[k - 1:]) & (words.start[:m] < own))
    return count_pairs(u[at], u[at + 1], units, p)


# --- the job ---------------------------------------------------------------------

def count_words(texts: DataFrame, p: PhraseParams) -> DataFrame:
    """(lang, u, word, c) of every word, and a row without a word for all words of a language."""
    schema = pa.schema([("lang", pa.string()), ("u", pa.int64()), ("word", pa.string()), ("c", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, own in chunks(batches, p.chunk_bytes, 0):
            w = words_of(lang, data)
            u, first, n = np.unique(w.units, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), len(u)), pa.array(u.view(np.int64)), _strings(data, w.start[first], w.end[first]), pa.array(n)], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0]), pa.nulls(1, pa.string()), pa.array([len(w.units)])], schema=schema)

    return texts.mapInArrow(counted, "lang string, u long, word string, c long").groupBy("lang", "u", "word").agg(F.sum("c").alias("c"))


def units_of(level: DataFrame, p: PhraseParams) -> Units:
    """Bitmap and hot units of a level's (u, c): both of bounded size."""
    bits = min(p.most_bits, max(15, (level.count() * 64 - 1).bit_length()))
    slot = F.col("u").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    blocks = level.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in blocks:
        out[(r.block - 1) * 4096:r.block * 4096] = np.frombuffer(r.bits, np.uint8)
    hot = [r.u for r in level.orderBy(F.desc("c"), "u").select("u").limit(p.hot).collect()]
    return Units(out, np.array(hot, np.int64).view(np.uint64))


def count_level(texts: DataFrame, k: int, units: Units, p: PhraseParams) -> DataFrame:
    """(a, b, c): phrases of k words that occur often enough, as pairs of units."""
    shared = texts.sparkSession.sparkContext.broadcast(units)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, own in chunks(batches, p.chunk_bytes, k - 1):
            a, b, n = pairs_of(words_of(lang, data), own, k, shared.value, p)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n)], schema=schema)

    return texts.mapInArrow(counted, "a long, b long, c long").groupBy("a", "b").agg(F.sum("c").alias("c")).filter(F.col("c") >= p.least)


def frequent_phrases(documents: DataFrame, params: PhraseParams = PhraseParams()) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and the frequent phrases of 1, 2, ... words:
    (u, a, b, lang, words, c, firsts, lasts), the last two being the counts of
    the phrase's first and last 1, 2, ... words."""
    p = params
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = pin(count_words(texts, p).filter((F.col("c") >= p.least) | F.col("word").isNull()), "phrases-words")
    totals = words.filter("word is null").select("lang", F.col("c").alias("n"))
    none = F.lit(None).cast("long")
    levels = [words.filter("word is not null").select("u", none.alias("a"), none.alias("b"), "lang", F.array("word").alias("words"), "c", F.array("c").alias("firsts"), F.array("c").alias("lasts"))]
    for k in range(2, p.longest + 1):
        below = levels[-1]
        x = below.select(F.col("u").alias("a"), "lang", F.col("words").alias("head"), "firsts")
        y = below.select(F.col("u").alias("b"), F.element_at("words", -1).alias("tail"), "lasts")
        got = (count_level(texts, k, units_of(below, p), p).join(x, "a").join(y, "b")
               .select(F.xxhash64("a", "b").alias("u"), "a", "b", "lang", F.array_append("head", F.col("tail")).alias("words"), "c",
                       F.array_append("firsts", F.col("c")).alias("firsts"), F.array_append("lasts", F.col("c")).alias("lasts")))
        levels.append(pin(got, f"phrases-{k}"))
    return totals, levels


def _weakest_cut(k: int) -> Column:
    """The lowest-scoring cut of a phrase of k words, of equal ones the first: (score, j, l, r)."""
    whole = "cast({} as decimal(16,0))".format       # three of them and 1000 fit 38 digits
    cuts = []
    for j in range(1, k):
        left, right = f"element_at(firsts, {j})", f"element_at(lasts, {k - j})"
        score = F.expr(f"cast(1000 as decimal(4,0)) * {whole('c')} * {whole('n')} div ({whole(left)} * {whole(right)})")
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("j"), F.expr(left).alias("l"), F.expr(right).alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(documents: DataFrame, params: PhraseParams = PhraseParams()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    p = params
    totals, levels = frequent_phrases(documents, p)
    kept = []
    for k in range(2, p.longest + 1):
        level = levels[k - 1].join(totals, "lang").withColumn("cut", _weakest_cut(k))
        if k < p.longest:
            # A longer phrase as frequent as this one has parts one word longer than this one that are, too.
            longer = levels[k].select(F.explode(F.array("a", "b")).alias("u"), F.col("c").alias("of")).groupBy("u").agg(F.max("of").alias("of"))
            level = level.join(longer, "u", "left").filter("of is null or of < c")
        kept.append(level.select("lang", F.array_join("words", " ").alias("phrase"), F.col("c").alias("a"), "cut.l", "cut.r", "n", "cut.score"))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (reduce(DataFrame.unionByName, kept).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= p.top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
