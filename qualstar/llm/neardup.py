"""Near-duplicate documents: b-bit MinHash, banding, exact confirmation.

1.  Each text becomes the set of its distinct shingles (runs of ``words`` words,
    hashed to 64 bits), its size, a 128-bit fingerprint of the whole set,
    ``perms`` minima, the low ``bits`` bits of these minima packed into longs,
    and a key per band of ``rows`` minima.  Texts are read once here.
2.  Documents with equal sets are one class with the smallest doc_id as its
    name: copies cost one aggregation, whatever their number.
3.  Candidates share a band key.  First each band bucket is a star around a
    class of it with the most copies, then around that with the most links.
    Candidates whose similarity, estimated from the equal packed values (bit
    counts, corrected for chance collisions of ``bits`` bits), is over
    ``least_estimate`` are confirmed on the full sets, and the confirmed links
    give components.
4.  Stars can miss a link between two outer classes of a bucket.  So buckets
    that hold more than one component meet again: classes of different
    components in one bucket.  The shingles that a set has in common with all
    other components together bound what it can share with any: the classes
    this rules out, most of a family of copies with many changes each, meet no
    one, so such a family isn't compared pair by pair.  For the others sizes,
    that bound and an estimate from a finer sketch are tested inside the join.  Links within a component can't change
    the result; all others are tested, so no link between different texts that
    banding brings together is lost.

With 32 bands of 4 a pair at similarity 0.75 shares no band with probability
5e-6; the estimate's standard error at 0.75 is 0.046, and 0.015 for the finer
sketch, so the bounds 0.5 and 0.675 are more than five of them away.

Texts without words or null texts have an empty set and no links.  Rows with
one doc_id and different texts are linked only as their texts are.  Components
are named by the smallest doc_id of their rows; null ids come last, and a
component of such rows alone has a null name.  ``kept`` marks the rows of that
doc_id (of its first class, if several bear it).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin
from .common import NO_ID, NON_SPACE, _splitmix, window_hashes, word_hashes
from .components import components


@dataclass(frozen=True)
class NearDupParams:
    words: int = 5
    percent: int = 75            # link if 100 * intersection >= percent * union
    perms: int = 128
    rows: int = 4                # minima per band
    bits: int = 2                # kept of each minimum: 1, 2 or 4
    least_estimate: float = 0.5
    fine_perms: int = 2048       # of the second sketch, of one bit each, which outer classes of a bucket get
    fine_estimate: float = 0.675

    @property
    def bands(self) -> int:
        return self.perms // self.rows

    @property
    def fine(self) -> NearDupParams:
        return replace(self, perms=self.fine_perms, bits=1)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words; of the whole text if it
    has fewer words; empty if it has none."""
    words, _, _ = word_hashes((text or "").encode("utf-8", "replace").lower(), NON_SPACE)
    return np.unique(window_hashes(words, min(n, len(words)))) if len(words) else words


class Sketcher:
    """Fingerprints, minima, packed low bits and band keys of shingle sets."""

    def __init__(self, p: NearDupParams):
        rng = np.random.default_rng(5)
        self.p = p
        self.mul = rng.integers(0, 1 << 62, p.perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, p.perms, dtype=np.uint64)
        self.lag = rng.integers(0, 1 << 62, p.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, s: np.ndarray) -> np.ndarray:
        low = np.full(self.p.perms, np.iinfo(np.uint64).max)
        with np.errstate(over="ignore"):
            for at in range(0, len(s), 512):
                h = s[at:at + 512] * self.mul[:, None]
                h += self.add[:, None]
                np.minimum(low, h.min(1), out=low)
        return low >> np.uint64(32)

    def print_of(self, s: np.ndarray) -> bytes:
        """128 bits that equal sets share, whatever their order."""
        with np.errstate(over="ignore"):
            a, b = _splitmix(s + np.uint64(1)), _splitmix(s ^ self.mul[0])
            return np.array([a.sum(dtype=np.uint64), np.bitwise_xor.reduce(b) + np.uint64(len(s)) * self.mul[1]], np.uint64).tobytes()

    def sketch(self, s: np.ndarray):
        """(fingerprint, packed, keys) as little-endian longs."""
        with np.errstate(over="ignore"):
            m = self.minima(s)
            # The low bits come from a mixed minimum: bits of a plain product are not independent of its size.
            low = _splitmix(m) & np.uint64((1 << self.p.bits) - 1)
            per = 64 // self.p.bits
            packed = (low.reshape(-1, per) << (np.arange(per, dtype=np.uint64) * np.uint64(self.p.bits))).sum(1, dtype=np.uint64)
            keys = _splitmix((m.reshape(-1, self.p.rows) * self.lag).sum(1, dtype=np.uint64) + np.arange(self.p.bands, dtype=np.uint64) * self.mul[2])
        return self.print_of(s), packed.view(np.int64), keys.view(np.int64)


def estimate(a: Column, b: Column, p: NearDupParams) -> Column:
    """Collision-corrected similarity of two packed sketches (arrays of long)."""
    mask = {1: -1, 2: 0x5555555555555555, 4: 0x1111111111111111}[p.bits]
    differ = F.lit(0)
    for k in range(p.perms * p.bits // 64):
        x = a[k].bitwiseXOR(b[k])
        for s in [p.bits // 2, p.bits // 4]:
            x = x.bitwiseOR(F.shiftrightunsigned(x, s)) if s else x
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(mask)))
    chance = 2.0 ** -p.bits
    return (1 - differ / p.perms - chance) / (1 - chance)


def sketches(documents: DataFrame, p: NearDupParams) -> DataFrame:
    """(id, n_shingles, print, packed, keys) of every row; print is null for
    texts without words."""
    @F.pandas_udf("n long, print binary, packed array<long>, keys array<long>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        tool, out = Sketcher(p), []
        for t in texts:
            s = shingles(t, p.words)
            out.append((len(s), *(tool.sketch(s) if len(s) else (None, None, None))))
        return pd.DataFrame(out, columns=["n", "print", "packed", "keys"])

    return (documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), sketched("text").alias("k"))
            .select("id", F.col("k.n").alias("n_shingles"), "k.print", "k.packed", "k.keys"))


def _sets(documents: DataFrame, classes: DataFrame, involved: DataFrame, p: NearDupParams) -> DataFrame:
    """(cls, s, n): the full set, as packed hashes, and its size of each class
    in ``involved(cls)``."""
    @F.pandas_udf("s binary, print binary")
    def full(texts: pd.Series) -> pd.DataFrame:
        tool = Sketcher(p)
        sets = [shingles(t, p.words) for t in texts]
        return pd.DataFrame({"s": [s.tobytes() for s in sets], "print": [tool.print_of(s) if len(s) else None for s in sets]})

    needed = involved.join(classes.select("cls", F.col("rep").alias("id"), F.col("print").alias("of")), "cls")
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    # Called nondeterministic, so that the join comes first and only texts needed are cut into shingles.  The
    # fingerprint tells the class's own text from others under the same doc_id.
    return (needed.join(texts, "id").select("cls", "of", full.asNondeterministic()("text").alias("f")).filter("f.print = of")
            .select("cls", "f.s").dropDuplicates(["cls"]).select("cls", "s", (F.length("s") / 8).cast("int").alias("n")))


def _confirm(sets: DataFrame, pairs: DataFrame, p: NearDupParams) -> DataFrame:
    """Those of ``pairs(a, b)`` of classes whose full sets reach the bound."""
    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y, strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= p.percent * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("s").alias("x")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("s").alias("y")), "b"))
    return both.filter(linked("x", "y")).select("a", "b")


def _shared_shingles(sets: DataFrame) -> DataFrame:
    """(cls, shared) for ``sets(cls, part, s)``: how many of a set's shingles
    stand in sets of other parts."""
    @F.pandas_udf("array<long>")
    def unpacked(s: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(x, np.int64) for x in s], dtype=object)

    each = sets.select("cls", "part", F.explode(unpacked("s")).alias("h"))
    common = each.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("h")
    return each.join(common, "h").groupBy("cls").agg(F.count("*").alias("shared"))


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _verdicts(documents: DataFrame, p: NearDupParams) -> DataFrame:
    """(id, print, n_shingles, component, kept) of every row of ``documents``."""
    rows = pin(sketches(documents, p), "neardup-rows")
    # A class is named by a hash of its fingerprint.
    classes = pin(rows.filter("print is not null").groupBy("print")
                  .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("packed").alias("packed"), F.first("keys").alias("keys"))
                  .withColumn("cls", F.xxhash64("print")), "neardup-classes")
    packed = classes.select("cls", "packed")
    banded = classes.select("cls", F.explode("keys").alias("key"))
    met = banded.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("key")
    members = pin(banded.join(met, "key"), "neardup-bands")
    sets = pin(_sets(documents, classes, members.select("cls").distinct(), p), "neardup-sets")

    def near(pairs: DataFrame) -> DataFrame:
        """Pairs (cls, hub), estimate first."""
        return (pairs.filter("cls <> hub").distinct().join(packed, "cls")
                .join(packed.select(F.col("cls").alias("hub"), F.col("packed").alias("of_hub")), "hub")
                .filter(estimate(F.col("packed"), F.col("of_hub"), p) >= p.least_estimate).select(*_ordered("cls", "hub")).distinct())

    def around(rank: DataFrame) -> DataFrame:
        """Each bucket's members with that of them that ``rank(cls, r)`` puts highest."""
        hubs = members.join(rank, "cls").groupBy("key").agg(F.max_by("cls", F.struct("r", "cls")).alias("hub"))
        return members.join(hubs, "key").select("cls", "hub")

    # The text that has been copied most is the likeliest centre; then the one with the most links so far.
    star = pin(near(around(classes.select("cls", F.col("copies").alias("r")))), "neardup-star")
    links = pin(_confirm(sets, star, p), "neardup-links")
    degree = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("r"))
    again = pin(near(around(degree)).join(star, ["a", "b"], "left_anti"), "neardup-star")
    tested = star.unionByName(again)
    links = pin(links.unionByName(_confirm(sets, again, p)), "neardup-links")
    found = pin(components(links), "neardup-parts")

    placed = (members.select("key", "cls").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
              .select("key", "cls", F.coalesce("component", "cls").alias("part")))
    mixed = placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("key")
    rest = pin(placed.join(mixed, "key"), "neardup-rest")
    # Two sets of different parts can't have more in common than either shares with other parts altogether.
    own = sets.join(rest.select("cls", "part").distinct(), "cls")
    @F.pandas_udf("array<long>")
    def finer(s: pd.Series) -> pd.Series:
        tool = Sketcher(p.fine)
        return pd.Series([tool.sketch(np.frombuffer(x, np.uint64))[1] for x in s], dtype=object)

    bounded = pin(own.select("cls", "n").join(_shared_shingles(own), "cls").filter(100 * F.col("shared") >= p.percent * F.col("n")), "neardup-bounds")
    sizes = pin(bounded.join(sets.select("cls", "s"), "cls").select("cls", "n", "shared", finer.asNondeterministic()("s").alias("packed")), "neardup-sizes")
    mine = rest.groupBy("cls").agg(F.collect_set("key").alias("keys"))   # as many as there are bands, at most
    rest_ = rest.join(sizes, "cls").join(mine, "cls")
    x, y = rest_.alias("x"), rest_.alias("y")
    met = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.part") < F.col("y.part"))
                  & (100 * F.least("x.n", "y.n") >= p.percent * F.greatest("x.n", "y.n"))
                  & ((100 + p.percent) * F.least("x.shared", "y.shared") >= p.percent * (F.col("x.n") + F.col("y.n")))
                  & (estimate(F.col("x.packed"), F.col("y.packed"), p.fine) >= p.fine_estimate)
                  # A pair that meets in several buckets counts in one of them.
                  & (F.col("x.key") == F.array_min(F.array_intersect("x.keys", "y.keys"))))
           .select(*_ordered("x.cls", "y.cls")).distinct())
    more = pin(met.join(tested, ["a", "b"], "left_anti"), "neardup-more")
    if more.limit(1).count():
        unpin(found)
        found = pin(components(links.unionByName(_confirm(sets, more, p))), "neardup-parts")
    unpin(members, sets, star, again, links, rest, bounded, sizes, more)

    # A component's first class has its smallest doc_id; the order of names decides where ids are repeated.
    parts = (classes.select("print", "cls", "rep").join(found.select(F.col("node").alias("cls"), "component"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))
    heads = parts.groupBy("component").agg(F.min(F.struct("rep", "cls")).alias("head"))
    parts = pin(parts.join(heads, "component").select("print", F.col("head.rep").alias("first"), (F.col("head.cls") == F.col("cls")).alias("leads")),
                "neardup-verdicts")
    unpin(classes, found)
    component = F.coalesce("first", "id")
    return (rows.select("id", "print", "n_shingles").join(parts, "print", "left")
            .select("id", "print", "n_shingles", component.alias("component"),
                    ((F.col("id") == component) & F.coalesce("leads", F.lit(True))).alias("kept")))


def near_duplicates(documents: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``documents``."""
    ident = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return _verdicts(documents, params).select(ident("id").alias("doc_id"), "n_shingles", ident("component").alias("component_id"), "kept")


def one_of_each(documents: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """``documents`` with one row of each component; columns unchanged.  Texts
    without words all stay; of rows repeated in id and text one stays."""
    @F.pandas_udf("binary")
    def fingerprint(texts: pd.Series) -> pd.Series:
        tool = Sketcher(params)
        sets = (shingles(t, params.words) for t in texts)
        return pd.Series([tool.print_of(s) if len(s) else None for s in sets], dtype=object)

    gone = (_verdicts(documents, params).filter("not kept").select("id", "print").distinct()
            .select("id", F.col("print").alias("of")))
    rows = documents.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                            fingerprint("text").alias("print"))
    left = rows.join(gone, (rows.id == gone.id) & (F.col("print") == F.col("of")), "left_anti")
    # Texts without words are told apart by their place, so that repeats of them stay.
    return (left.withColumn("own", F.when(F.col("print").isNull(), F.monotonically_increasing_id()))
            .dropDuplicates(["id", "print", "own"]).select("row.*"))
