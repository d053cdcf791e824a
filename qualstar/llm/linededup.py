"""Line dedup by pairwise alignment.

Overlapping documents are found through two kinds of keys.  The first is the
hash of a rare line: one in at most ``rare_rows`` rows.  Every rare line links
the documents that hold it to the first of them (smallest doc_id), and counts
its words for that pair; pairs with ``min_words`` words of rare lines are
aligned.  A more frequent line may stand in any text and says nothing alone, so
the second key, which has no bound of frequency, is a run of lines: from each
line on, as many following lines as it takes to reach ``min_words`` words, and
up to each line as many lines before it.  Every line of a block of at least
that size is in one of the block's runs: in the one that ends at it, or near
the block's begin in the first.  A key in n documents gives n - 1 links however
many share it, and a passage goes whichever earlier document has it.

Each pair is aligned by patience diff over the documents' line hashes: lines
unique in both, the longest increasing sequence of their positions, blocks
grown around these anchors, the gaps again.  Aligned blocks of at least
``min_words`` words are deleted from the later document, whole lines at a time.
If the aligned rare lines of the pair have ``min_words`` words together, as in a
copy with changes strewn over it, so are shorter aligned blocks of at least
``block_words`` words that hold one of these lines.  Shared runs that no
order-keeping alignment reaches (moved passages) are matched after it.  Every
other line stays as it was: a line or short passage that texts share which have
little else in common is no copy.

Only hashes are shuffled for pairs and alignment; the texts take one join with
the lines to delete.  Lines are compared with white space runs as one blank.
A null or empty text has no lines and stays.  Rows that share a doc_id are one
document: not compared with each other, all treated alike.  Rows without a
doc_id come after all others, in the order of their texts' hashes, each a
document of its own; of those with equal texts one is the first, and the others
lose all their lines if these have ``min_words`` words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import NO_ID


@dataclass(frozen=True)
class LineParams:
    min_words: int = 50       # words of a passage, and of the rare lines of a pair that overlaps
    block_words: int = 5      # words of a shorter block with a rare line, in pairs that overlap
    rare_rows: int = 50       # a line in more rows than this is not rare (runs of lines may be)
    hot_keys: int = 2000      # bound of the most frequent keys, which are broadcast


def line_keys(text: str | None) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hash and words of each line that has words, and its index in the text."""
    hashes, words, at = [], [], []
    for i, line in enumerate((text or "").split("\n")):
        w = line.split()
        if w:
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(w).encode("utf-8", "replace")))
            words.append(len(w))
            at.append(i)
    return np.array(hashes, np.uint64), np.array(words, np.int64), at


def run_spans(words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """The shortest runs of ``min_words`` words from each line on and up to each line."""
    total = np.concatenate(([0], np.cumsum(words)))
    ends = np.searchsorted(total, total[:-1] + min_words)
    begins = np.searchsorted(total, total[1:] - min_words, "right") - 1
    return sorted({(i, int(e)) for i, e in enumerate(ends) if e <= len(words)} | {(int(b), j + 1) for j, b in enumerate(begins) if b >= 0})


def run_keys(hashes: np.ndarray, words: np.ndarray, min_words: int) -> list[int]:
    return list({xxhash.xxh3_64_intdigest(hashes[i:j].tobytes()): None for i, j in run_spans(words, min_words)})


def _anchors(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Positions of values unique in both, thinned to an increasing sequence."""
    ua, ia, ca = np.unique(a, return_index=True, return_counts=True)
    ub, ib, cb = np.unique(b, return_index=True, return_counts=True)
    _, x, y = np.intersect1d(ua[ca == 1], ub[cb == 1], assume_unique=True, return_indices=True)
    pa, pb = ia[ca == 1][x], ib[cb == 1][y]
    order = np.argsort(pa)
    pa, pb = pa[order], pb[order]
    tails: list[int] = []            # values of pb, and below the items they stand for
    items: list[int] = []
    before = np.full(len(pb), -1)
    for k, v in enumerate(pb):
        at = int(np.searchsorted(tails, v))
        before[k] = items[at - 1] if at else -1
        tails[at:at + 1], items[at:at + 1] = [v], [k]
    out, k = [], items[-1] if items else -1
    while k >= 0:
        out.append((int(pa[k]), int(pb[k])))
        k = int(before[k])
    return out[::-1]


def patience_match(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each position of ``b`` the position of ``a`` aligned with it, or -1."""
    to = np.full(len(b), -1)
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            to[b0] = a0
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            to[b1] = a1
        if a0 == a1 or b0 == b1:
            continue
        found = _anchors(a[a0:a1], b[b0:b1])
        if found:
            for (x0, y0), (x1, y1) in zip([(a0 - 1, b0 - 1), *[(x + a0, y + b0) for x, y in found]],
                                          [*[(x + a0, y + b0) for x, y in found], (a1, b1)], strict=True):
                if y1 < b1:
                    to[y1] = x1
                gaps.append((x0 + 1, x1, y0 + 1, y1))
    return to


def shared_blocks(a: np.ndarray, b: np.ndarray, b_words: np.ndarray, min_words: int,
                  rare: np.ndarray | None = None, block_words: int = 5) -> np.ndarray:
    """Positions of ``b`` in blocks of at least ``min_words`` words that are
    aligned with ``a``, moved blocks included, and, if the aligned lines among
    the hashes ``rare`` have as many words together, in aligned blocks of
    ``block_words`` words with such a line."""
    to = patience_match(a, b)
    drop = np.zeros(len(b), bool)
    marked = (to >= 0) & np.isin(b, () if rare is None else rare)
    overlap = b_words[marked].sum() >= min_words
    total = np.concatenate(([0], np.cumsum(b_words)))
    breaks = np.flatnonzero((to[1:] != to[:-1] + 1) | (to[1:] < 0)) + 1
    for i, j in zip([0, *breaks], [*breaks, len(b)], strict=True):
        if i < j and to[i] >= 0:
            size = total[j] - total[i]
            drop[i:j] = size >= min_words or (overlap and size >= block_words and marked[i:j].any())
    spans = [(i, j) for i, j in run_spans(b_words, min_words) if not drop[i:j].all()]
    if spans:
        where: dict[int, list[int]] = {}
        for k, v in enumerate(a.tolist()):
            where.setdefault(v, []).append(k)
        for i, j in spans:
            if drop[i:j].all():
                continue
            for k in where.get(int(b[i]), ()):
                if k + j - i <= len(a) and np.array_equal(a[k:k + j - i], b[i:j]):
                    end = j
                    while end < len(b) and k + end - i < len(a) and a[k + end - i] == b[end]:
                        end += 1
                    drop[i:end] = True
                    break
    return np.flatnonzero(drop)


def without_lines(text: str | None, drop) -> str | None:
    """The text without its lines of words number ``drop``."""
    if text is None or drop is None or not len(drop):
        return text
    gone, n, kept = set(int(x) for x in drop), -1, []
    for line in text.split("\n"):
        n += bool(line.split())
        if not (line.split() and n in gone):
            kept.append(line)
    return "\n".join(kept)


_KEYS = ["id", "tie", "th"]


def _keys() -> list[Column]:
    """Documents are ordered by id and tie, which is 0 where there is a doc_id
    and above it where not; th tells texts of one id apart."""
    th = F.xxhash64("text")
    tie = F.when(F.col("doc_id").isNull(), th.bitwiseAND(F.lit(NO_ID)).bitwiseOR(F.lit(1))).otherwise(F.lit(0)).cast("long")
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), tie.alias("tie"), th.alias("th")]


def _keyed(documents: DataFrame) -> DataFrame:
    """The whole row as one column, beside the keys: no name can clash."""
    return documents.select(F.struct("*").alias("row"), *_keys())


def line_table(documents: DataFrame, params: LineParams) -> DataFrame:
    """(id, tie, th, hashes, words, runs, lines, sizes) of every row: its runs'
    keys, its different lines' hashes and their words."""
    @F.pandas_udf("hashes binary, words binary, runs array<long>, lines array<long>, sizes array<int>")
    def keys(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            h, w, _ = line_keys(t)
            runs = run_keys(h, w, params.min_words)
            different, at = np.unique(h, return_index=True)
            out.append((h.tobytes(), w.astype(np.int32).tobytes(), np.array(runs, np.uint64).view(np.int64),
                        different.view(np.int64), w[at].astype(np.int32)))
        return pd.DataFrame(out, columns=["hashes", "words", "runs", "lines", "sizes"])

    return documents.select(*_keys(), keys("text").alias("k")).select(*_KEYS, "k.*")


def shared_lines(lines: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """(id, tie, th, drop array<int>): lines of words to delete, by number, of each
    document of ``lines`` that loses any to another."""
    # A run's key has no size; runs and lines take the same shuffles.
    run = F.transform("runs", lambda r: F.struct(r.alias("key"), F.lit(0).alias("size")))
    line = F.transform(F.arrays_zip("lines", "sizes"), lambda x: F.struct(x["lines"].alias("key"), x["sizes"].alias("size")))
    keys = lines.select("id", "tie", F.inline(F.concat(run, line)))
    # Ties are 0 but for the last of all ids, so the least id and the least tie are of one row.
    shared = pin(keys.groupBy("key", "size").agg(F.min("id").alias("a_id"), F.min("tie").alias("a_tie"), F.max("id").alias("z_id"), F.max("tie").alias("z_tie"),
                                                 F.count("*").alias("n"))
                 .filter("a_id < z_id or a_tie < z_tie").drop("z_id", "z_tie"), "line-keys")
    # Keys with more than this share of all occurrences are fewer than hot_keys, so
    # these may be broadcast: no task of the join meets one of them alone.
    n = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = F.col("n") * params.hot_keys > n
    useful = (F.col("size") == 0) | (F.col("n") <= params.rare_rows)
    few = F.broadcast(shared.filter(hot))
    links = (keys.join(few.filter(useful).drop("n"), ["key", "size"])
             .unionByName(keys.join(few, ["key", "size"], "left_anti").join(shared.filter(useful & ~hot).drop("n"), ["key", "size"])))
    rare = F.collect_set(F.when(F.col("size") > 0, F.struct("key", "size")))
    links = links.filter("id > a_id or tie > a_tie").groupBy("id", "tie", "a_id", "a_tie").agg(F.min("size").alias("least"), rare.alias("rare"))
    words = F.aggregate("rare", F.lit(0).cast("long"), lambda total, x: total + x["size"])
    pairs = pin(links.filter((F.col("least") == 0) | (words >= params.min_words)).select("id", "tie", "a_id", "a_tie", F.col("rare.key").alias("rare")), "line-pairs")

    def align(batches):
        for pdf in batches:
            found = [shared_blocks(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), np.frombuffer(w, np.int32), params.min_words,
                                   np.asarray(r, np.int64).view(np.uint64), params.block_words)
                     for a, b, w, r in zip(pdf.a, pdf.hashes, pdf.words, pdf.rare, strict=True)]
            yield pd.DataFrame({"id": pdf.id, "tie": pdf.tie, "th": pdf.th, "lines": found})

    earlier = lines.select(F.col("id").alias("a_id"), F.col("tie").alias("a_tie"), F.col("hashes").alias("a")).dropDuplicates()
    later = lines.select(*_KEYS, "hashes", "words").dropDuplicates(_KEYS)
    aligned = (pairs.join(earlier, ["a_id", "a_tie"]).select("id", "tie", "a", "rare").join(later, ["id", "tie"])
               .mapInPandas(align, "id long, tie long, th long, lines array<int>"))
    return (aligned.select(*_KEYS, F.explode("lines").alias("line")).distinct()
            .groupBy(*_KEYS).agg(F.sort_array(F.collect_list("line")).alias("drop")))


def _with_cuts(documents: DataFrame, params: LineParams) -> DataFrame:
    """(row: the document, deduped, n_removed) of every row."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, drops: pd.Series) -> pd.Series:
        return pd.Series([without_lines(t, d) for t, d in zip(texts, drops, strict=True)], dtype=object)

    lines = pin(line_table(documents, params), "lines")
    # Written, so that a row's place is the same whenever it is read.
    place = F.monotonically_increasing_id()
    nameless = pin(_keyed(documents.filter("doc_id is null")).withColumn("place", place), "line-nameless")
    places = nameless.groupBy(*_KEYS).agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    sizes = lines.filter("tie > 0 and size(runs) > 0").groupBy(*_KEYS).agg(F.first(F.octet_length("words") / 4).cast("int").alias("n_lines"))
    cuts = shared_lines(lines, params).join(places.join(sizes, _KEYS), _KEYS, "full")

    rows = _keyed(documents.filter("doc_id is not null")).withColumn("place", F.lit(None).cast("long")).unionByName(nameless)
    again = F.when(F.col("place") > F.col("first"), F.sequence(F.lit(0), F.col("n_lines") - 1))
    both = rows.join(cuts, _KEYS, "left").withColumn("drop", F.coalesce(again, "drop"))
    text = F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(cut(F.col("row.text"), F.col("drop")))
    return both.select("row", text.alias("deduped"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_removed"))


def dedup_lines(documents: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """``documents`` with two columns more: ``deduped`` (the text without the
    deleted lines) and ``n_removed`` (lines deleted), which replace columns of
    these names.  All rows stay."""
    return _with_cuts(documents.drop("deduped", "n_removed"), params).select("row.*", "deduped", "n_removed")


def replace_text(documents: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """``documents`` with deduplicated texts and, if there is such a column,
    ``n_chars`` of the new text; columns unchanged."""
    kinds = dict(documents.dtypes)
    new = {"text": F.col("deduped")}
    if "n_chars" in kinds:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("deduped")).otherwise(F.col("row.n_chars")).cast(kinds["n_chars"])
    return _with_cuts(documents, params).select([new.get(c, F.col("row")[c]).alias(c) for c in documents.columns])
