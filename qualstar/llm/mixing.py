"""Mixing sources to target weights by pivotal dependent rounding.

Sources in the order of their names (null last) weigh ``weights`` in turn and
share all words by weight; no source gets more than ``max_repeats`` times its
own words, and what it can't take is shared by the others.  Every document of a
source then has the same expected number of copies, its source's target over
its size.  The whole part is certain.  The fraction is a probability that is
settled by pivotal rounding: two documents exchange mass (probability times
words), at random and without changing either's expectation, until one of them
is at 0 or 1; that one is settled and the other meets the next document, the
longest first.  The expected words of a source never change on the way, so its
words in the mix differ from the target by less than the one document left at
the end, in most cases a short one.

Documents are dealt by a hash of their id and text to blocks of about
``block_rows`` rows of one source; each block is rounded on its own and leaves
one unsettled document, and these meet again, ``fan_in`` blocks at a time, until
one is left per source: a tree whose groups are small however large a source
is.  Random numbers come from a hash of the ids met, so reruns agree on any
cluster.  The texts are read once, to count words; rows of ids and sizes only
are shuffled.

Documents without words (or null texts) have size 0 and take 0 words; their
copies are the whole part only, so they meet in no block.  Rows repeated in id
and text are documents of their own, settled in turn: they travel as counts, in
chunks of a tenth of a block that are dealt to one block after the other, so no
block holds all of them.  An empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import assign_dense_keys
from ..session import pin
from .common import NO_ID, _splitmix


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_repeats: int = 3
    block_rows: int = 10000
    fan_in: int = 64
    seed: int = 1


def word_count(text: str | Column) -> Column:
    """Runs of anything but ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, params: MixParams) -> DataFrame:
    """(source, source_size, n_rows, target) from ``sizes(source, size)``.

    A target is the smaller of cap and weight x level; each pass gives the
    level to the sources not capped so far, until no more reach their caps.
    Only one row per source is touched, by Spark, whatever their number.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    named = sources.select(F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"),
                           "source", "source_size", "n_rows")
    w = F.array(*[F.lit(float(x)) for x in params.weights])
    ranked = assign_dense_keys(named, ["last", "name"], "rank")
    ranked = pin(ranked.select("source", "source_size", "n_rows", (F.col("source_size") * params.max_repeats).alias("cap"),
                               w[(F.col("rank") % len(params.weights)).cast("int")].alias("weight")), "mix-sources")
    total = ranked.agg(F.sum("source_size").alias("s")).first().s or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * level
        r = ranked.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("taken"),
                       F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if r.n == capped or not r.open:
            break
        level, capped = (total - (r.taken or 0)) / r.open, r.n
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "n_rows", target.alias("target"))


def _uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = _splitmix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed * 1000003 + 17))
    return (x >> np.uint64(11)) / 2.0 ** 53


def pivot(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, int]:
    """Settle probabilities one against the next, exchanging words.  Returns
    them and the place of the one still between 0 and 1 (-1: none)."""
    out, hold = p.tolist(), -1
    eps, sizes, us = 1e-9, size.tolist(), u.tolist()
    for j in range(len(out)):
        if out[j] <= eps or out[j] >= 1 - eps:
            out[j] = round(out[j])
            continue
        if hold < 0:
            hold = j
            continue
        a, b = sizes[hold], sizes[j]
        up = min((1 - out[hold]) * a, out[j] * b)        # words that may move to the held document
        down = min(out[hold] * a, (1 - out[j]) * b)
        t = up if us[j] * (up + down) < down else -down
        out[hold] += t / a
        out[j] -= t / b
        left = [k for k in (hold, j) if eps < out[k] < 1 - eps]
        for k in (hold, j):
            if k not in left:
                out[k] = round(out[k])
        hold = left[0] if left else -1
    return np.array(out), hold


_ROW = "doc_id long, key long, size long, source string, copy long, block long, whole long, p double"


def _round_groups(rows: DataFrame, by: list[str], seed: int) -> DataFrame:
    """One row for each of the ``n`` equal rows that a row stands for, settled;
    ``copy`` numbers them."""
    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(pdf["n"])].drop(columns="n")
        pdf["copy"] += pdf.groupby(level=0).cumcount()
        pdf = pdf.sort_values(["size", "key", "doc_id", "copy"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        open_ = np.flatnonzero(((pdf["p"] > 0) & (pdf["p"] < 1)).to_numpy())
        part = pdf.iloc[open_]
        # The first copy is drawn by the key alone, the others by numbers of their own.
        copy = part["copy"].to_numpy(np.int64).view(np.uint64)
        with np.errstate(over="ignore"):
            mixed = part["key"].to_numpy(np.int64).view(np.uint64) + np.where(copy > 0, _splitmix(copy), np.uint64(0))
        u = _uniform(mixed.view(np.int64), seed)
        got, hold = pivot(part["p"].to_numpy(float), part["size"].to_numpy(float), u)
        pdf.loc[open_, "p"] = got
        pdf["open"] = False
        if hold >= 0:
            pdf.loc[open_[hold], "open"] = True
        return pdf

    return rows.groupBy(*by).applyInPandas(settle, _ROW + ", open boolean")


def mix(documents: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """(doc_id, key, size, source, source_size, target, copies, taken) of every
    row; ``key`` is a hash of id and text."""
    p = params
    sizes = pin(documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"),
                                 F.col("source").cast("string").alias("source"), word_count("text").alias("size")), "mix-sizes")
    targets = pin(source_targets(sizes, p), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A copy's fraction within rounding of a whole number is that number.
    near = F.when(F.abs(share - F.round(share)) < 1e-12, F.round(share)).otherwise(share)
    same = sizes.source.eqNullSafe(targets.source)
    blocks = F.ceil(F.col("n_rows") / p.block_rows)
    whole, chunk = F.floor(near).alias("whole"), max(1, p.block_rows // 10)
    empty = (sizes.filter("size = 0").join(targets, same).select("doc_id", "key", "size", sizes.source, F.lit(0).cast("long").alias("copy"),
             F.lit(0).cast("long").alias("block"), whole, F.lit(0.0).alias("p"), F.lit(False).alias("open")))
    equal = (sizes.filter("size > 0").groupBy("doc_id", "key", "size", "source").agg(F.count("*").alias("of"))
             .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1, F.lit(chunk).cast("long")))))
    # Copies of a chunk begin at its number; chunk k goes k blocks on.
    rows = (equal.join(targets, equal.source.eqNullSafe(targets.source))
            .select("doc_id", "key", "size", equal.source, "copy",
                    F.pmod(F.pmod("key", blocks) + F.floor(F.col("copy") / chunk), blocks).cast("long").alias("block"),
                    whole, (near - F.floor(near)).alias("p"), F.least(F.col("of") - F.col("copy"), F.lit(chunk)).alias("n")))
    done, level = [empty], pin(_round_groups(rows, ["source", "block"], p.seed), "mix-level")
    widest = targets.agg(F.max(blocks).alias("b")).first().b or 0
    depth = 0
    while True:
        done.append(level.filter("not open"))
        if widest <= 1:
            break
        depth, widest = depth + 1, -(-widest // p.fan_in)
        up = level.filter("open").drop("open").withColumn("block", F.floor(F.col("block") / p.fan_in)).withColumn("n", F.lit(1))
        level = pin(_round_groups(up, ["source", "block"], p.seed + depth), "mix-level")
    # One document per source is still open: it is drawn on its own.
    draw = F.pmod(F.xxhash64("key", F.lit(p.seed)), F.lit(1 << 30)) / float(1 << 30)
    done.append(level.filter("open").withColumn("p", (draw < F.col("p")).cast("double")))
    settled = reduce(DataFrame.unionByName, done)
    copies = (F.col("whole") + F.round("p")).cast("long")
    return (settled.join(targets, settled.source.eqNullSafe(targets.source))
            .select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "key", "size", settled.source, "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")))


def mixture(documents: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The documents of the mix: the rows of ``documents`` that it takes at
    least once (documents without a word give it nothing), with size, source_size, target, copies and taken beside their
    own columns (of that name, these replace them)."""
    new = ["size", "source_size", "target", "copies", "taken"]
    plan = mix(documents, params).filter("copies > 0 and size > 0").withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    # Rows repeated in id and text share a key: one of them stands for their copies together.
    plan = (plan.groupBy("id", "key").agg(*[F.first(c).alias(c) for c in new[:3]], F.sum("copies").alias("copies"), F.sum("taken").alias("taken")))
    rows = (documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                             F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key")).dropDuplicates(["id", "key"]))
    keep = [c for c in documents.columns if c.lower() not in new]
    return rows.join(plan, ["id", "key"]).select(*[F.col("row")[c].alias(c) for c in keep], *new)
