"""Helpers shared by the operators: reading tables, sampling labelled rows,
hashing words and byte n-grams in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Stands for a null id where ids are compared or ordered: null ids come last.
NO_ID = (1 << 63) - 1


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows are whole texts: send Python workers fewer at a time than Spark's
    default of 10000, unless the session has a setting of its own."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: null)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(col.cast("string").cast("binary")) % folds


def stratified_ids(labelled: DataFrame, per_class: int, max_labels: int = 4096) -> DataFrame:
    """At most ``per_class`` rows of each label of ``labelled(doc_id, label)``,
    those with the smallest id hashes; rows null in either column take no part.
    Ids should be distinct.  Of more than ``max_labels`` labels the most
    frequent take part: their counts are broadcast.

    Hashes are uniform, so the rows sought lie below a share of their range
    that follows from the label's count; only rows below it (and ten standard
    deviations more) are ranked.  So what meets in a label's task has a bound,
    however many rows or tasks there are.
    """
    rows = labelled.filter("doc_id is not null and label is not null").withColumn("_u", F.xxhash64("doc_id") / 2.0 ** 64 + 0.5)
    counts = rows.groupBy("label").agg(F.count("*").alias("_of")).orderBy(F.desc("_of"), "label").limit(max_labels)
    w = W.partitionBy("label").orderBy("_u", "doc_id")
    return (rows.join(F.broadcast(counts), "label").filter(F.col("_u") * F.col("_of") <= per_class + 10 * per_class ** 0.5 + 100)
            .withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_class).drop("_n", "_u", "_of"))


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LAG = _RNG.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 16


def _powers(base: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.full(_BLOCK, base, np.uint64))).cumprod(dtype=np.uint64)


_POW, _POW_INV = _powers(_BASE), _powers(_BASE_INV)


def _at(powers: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """powers[1] ** exponent for exponents of any size (ascending)."""
    if not len(exponent) or exponent[-1] < _BLOCK:
        return powers[exponent]
    out = powers[exponent % _BLOCK]
    high = exponent // _BLOCK
    step = int(powers[_BLOCK])
    if len(high) and high.max():
        with np.errstate(over="ignore"):
            big = np.array([pow(step, k, 1 << 64) for k in range(int(high.max()) + 1)], np.uint64)
            out = out * big[high]
    return out


def word_hashes(data: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes, starts and ends of the words of ``data``: longest runs of
    bytes b with ``is_word[b]``.  Equal words have equal hashes in any text.

    A word's hash is the polynomial of its bytes' random codes, taken from one
    running sum over the text, so no word is handled on its own.
    """
    b = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([0], is_word[b].view(np.int8), [0])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), start, end
    with np.errstate(over="ignore"):
        run = np.empty(len(b) + 1, np.uint64)
        run[0] = 0
        np.cumsum(_BYTE[b] * (_POW[:len(b)] if len(b) <= _BLOCK else _at(_POW, np.arange(len(b)))), out=run[1:])
        h = (run[end] - run[start]) * _at(_POW_INV, start)
        h += (end - start).astype(np.uint64) * _LAG[63]
    return _splitmix(h), start, end


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (n < 60)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(words) - n + 1, np.uint64(n) * _LAG[62])
        for k in range(n):
            out += words[k:len(words) - n + 1 + k] * _LAG[k]
    return _splitmix(out)


def byte_grams(data: bytes, orders: tuple[int, ...]):
    """For each order n (at most 7): every n-gram of bytes of ``data`` packed
    into one unsigned 64-bit number, with n in the top byte."""
    v = {1: np.frombuffer(data, np.uint8).astype(np.uint64)}

    def packed(n):
        if n not in v:
            a = 4 if n > 4 else 2 if n > 2 else 1
            left, right = packed(a), packed(n - a)
            m = max(0, len(v[1]) - n + 1)
            v[n] = left[:m] | (right[a:a + m] << np.uint64(8 * a))
        return v[n]

    for n in orders:
        yield packed(n) | (np.uint64(n) << np.uint64(56))


def char_grams(codes: np.ndarray, orders: tuple[int, ...]):
    """For each order n: a 64-bit hash of every n-gram of ``codes`` (code points);
    n-grams of different orders or code points have different hashes (but for chance)."""
    with np.errstate(over="ignore"):
        g = one = codes.astype(np.uint64) + np.uint64(1)
        for n in range(1, max(orders) + 1):
            if n > 1:
                m = max(0, len(one) - n + 1)
                g = g[:m] * _BASE + one[n - 1:n - 1 + m]
            if n in orders:
                yield g * _LAG[n] + _LAG[n + 32]


#: Words of shingles: anything but ASCII white space (0x20 and 0x09 to 0x0D).
NON_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: Words of the benchmark filter: ASCII digits, lower-case letters and all else beyond ASCII.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
