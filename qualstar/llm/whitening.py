"""Whitening of embeddings by singular values of the centred rows.

Entries are put on a grid: x = floor(scale * c) + shift, whole numbers, so
counts and sums are exact.  The fit list holds each distinct x vector once;
n is its length, S its sums.  Its rows are centred (x - S/n, the whole part of
S/n taken off in whole numbers first) and reduced by QR, block by block in each
task, then the triangles R of all tasks in a tree of ``fan_in``; so V = R'R / n
is never formed, and what meets in one task is ``fan_in`` triangles.

Of R, dims x dims, the driver finds the directions: Householder reflections
make it bidiagonal, R = Q B P'; dqds gives the squares of B's singular values,
smallest first, each to high relative accuracy; twisted factorisations of
B'B - e give their vectors y, and P y is the component.  Vectors of close values
are made orthogonal to each other.  Components come by falling eigenvalue, with
the sign that makes the largest entry positive.

Rows take part if their vector is not null, holds no null or non-finite entry
and no entry whose x is beyond 2**52, and has the most frequent length (of equal
ones the longest; empty vectors never take part).  Every such row is returned,
repeated ones and those without an id too.  Components without variance
(eigenvalues below 1e-13 of the largest one) can't be whitened and are left
out, so a table of one distinct vector, like an empty one, gives no rows.  A
deviation that passes 64 bits is null.  Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin, unpin

_EPS = np.finfo(float).eps
_LARGEST = 2.0 ** 52
_SPLIT = 26                       # bits of the low part of a sum


@dataclass(frozen=True)
class WhitenParams:
    components: int = 16
    scale: int = 64
    shift: int = 1000000
    block_rows: int = 4096        # rows that one QR takes
    fan_in: int = 16              # triangles that one task of the tree takes


# --- small dense algebra, on one triangle -----------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, P) with R = Q B P', by Householder reflections from both sides."""
    a = np.array(r, float)
    d = len(a)
    right = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        v, size = x.copy(), np.linalg.norm(x)
        if len(x) < 2 or np.linalg.norm(x[1:]) == 0:
            return None
        v[0] += np.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        if (v := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d and (v := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step with a shift: new q and e, and the d of the way."""
    d, qs, es, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        ds.append(d)
        top = d + e[k]
        t = q[k + 1] / top
        qs.append(top)
        es.append(e[k] * t)
        d = d * t - shift
    return qs + [d], es, ds + [d]


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the upper bidiagonal matrix with
    diagonal ``a`` and superdiagonal ``b``, falling.

    The shift is 1 / sum(1 / d) over the d of a step without one: the trace of
    the inverse, so it never exceeds the smallest value and approaches it as
    Newton's method does.
    """
    a = np.abs(a)
    tiny = (max(a.max(initial=0), np.abs(b).max(initial=0)) or 1.0) * 1e-30
    q, e = (np.maximum(a, tiny) ** 2).tolist(), (b ** 2).tolist()
    found, parts = [], [(q, e, 0.0)]
    while parts:
        q, e, taken = parts.pop()
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= _EPS * _EPS * (taken + min(q[k], q[k + 1]))), None)
            if cut is not None:
                parts.append((q[cut + 1:], e[cut + 1:], taken))
                q, e = q[:cut + 1], e[:cut]
                continue
            q0, e0, ds = _step(q, e, 0.0)
            if min(ds) <= 0:                     # underflow: nothing to tell from the value taken off already
                q, e = [max(x, tiny * tiny) for x in q0], e0
                continue
            shift = 1 / sum(1 / x for x in ds)
            q1, e1, ds = _step(q0, e0, shift) if shift > _EPS * (taken or tiny * tiny) else (q0, e0, ds)
            # Rounding can overshoot by a hair: then the step without a shift counts.
            if q1 is q0 or min(ds) < 0 or not np.isfinite(q1[-1]):
                q, e = q0, e0
                if shift <= _EPS * taken:        # the smallest value is the one taken off, to the last bit
                    k = int(np.argmin(q))
                    if k == len(q) - 1:
                        e[-1] = 0.0
            else:
                q, e, taken = q1, e1, taken + shift
        found.append(taken + max(q[0], 0.0))
    return np.sort(np.array(found))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit vector y with (B'B - value) y as small as a twisted factorisation
    makes it: from the top and from the bottom to the row of the least pivot."""
    n, small = len(a), _EPS * (value or 1e-300)
    q, l, u = a * a, np.empty(n - 1), np.empty(n - 1)
    nonzero = lambda x: x if abs(x) > small * _EPS else -small * _EPS
    # Stationary: B'B = L D L' with D = a**2 and L's entries b/a; s is the pivot less a**2.
    s = np.empty(n)
    s[0] = -value
    for k in range(n - 1):
        pivot = nonzero(q[k] + s[k])
        l[k] = a[k] * b[k] / pivot
        s[k + 1] = l[k] * (b[k] / (a[k] or small)) * s[k] - value if a[k] else b[k] * b[k] - value
    # Progressive, from the bottom.
    p = np.empty(n)
    p[-1] = q[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = nonzero(b[k] * b[k] + p[k + 1])
        u[k] = a[k] * b[k] / pivot
        p[k] = p[k + 1] * (q[k] / pivot) - value
    at = int(np.argmin(np.abs(s + p + value)))
    y = np.zeros(n)
    y[at] = 1
    for k in range(at - 1, -1, -1):
        y[k] = -l[k] * y[k + 1]
    for k in range(at, n - 1):
        y[k + 1] = -u[k] * y[k]
    return y / np.linalg.norm(y)


def _refined(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray, seed: int) -> np.ndarray:
    """A vector of ``value`` orthogonal to ``others`` (vectors of close values), by inverse steps."""
    n = len(a)
    main = a * a + np.concatenate(([0], b * b)) - value
    off = a[:-1] * b
    scale = np.abs(main).max() + np.abs(off).max(initial=0) or 1.0
    y = np.random.default_rng(seed).normal(size=n)
    for _ in range(4):
        y -= others.T @ (others @ y)
        y = _tridiagonal_solve(main, off, y / np.linalg.norm(y), scale * _EPS)
        for _ in range(2):
            y -= others.T @ (others @ y)
            y /= np.linalg.norm(y)
    return y


def _tridiagonal_solve(main: np.ndarray, off: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Elimination with row exchanges of a symmetric tridiagonal system."""
    n = len(main)
    d, u1, u2, x = main.copy(), np.append(off, 0.0), np.zeros(n), y.copy()
    for k in range(n - 1):
        low, nxt, nxt1 = off[k], d[k + 1], u1[k + 1]
        if abs(low) > abs(d[k]):
            d[k], u1[k], u2[k], d[k + 1], u1[k + 1], low = low, nxt, nxt1, u1[k], u2[k], d[k]
            x[k], x[k + 1] = x[k + 1], x[k]
            nxt, nxt1 = d[k + 1], u1[k + 1]
        f = low / (d[k] or least)
        d[k + 1], u1[k + 1], x[k + 1] = nxt - f * u1[k], nxt1 - f * u2[k], x[k + 1] - f * x[k]
    for k in range(n - 1, -1, -1):
        x[k] = (x[k] - (u1[k] * x[k + 1] if k + 1 < n else 0) - (u2[k] * x[k + 2] if k + 2 < n else 0)) / (d[k] if abs(d[k]) > least else least)
    return x


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of R'R and their unit vectors, by row."""
    a, b, right = bidiagonal(r)
    norm = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if not norm:
        return np.empty(0), np.empty((0, len(a)))
    a = np.where(np.abs(a) < norm * 1e-30, norm * 1e-30, a)
    b = np.where(np.abs(b) < norm * _EPS * 1e-2, 0.0, b)
    # Where the superdiagonal is 0 the matrix falls apart, and each part has vectors of its own.
    ends = [0, *(np.flatnonzero(b == 0) + 1), len(a)]
    all_ = sorted(((v, lo, hi) for lo, hi in zip(ends, ends[1:], strict=False) for v in dqds(a[lo:hi], b[lo:hi - 1])), key=lambda x: -x[0])
    values, vectors, spans = [], [], []
    for v, lo, hi in all_[:most]:
        if v <= all_[0][0] * 1e-13:
            break
        part = twisted(a[lo:hi], b[lo:hi - 1], v)
        close = [y[lo:hi] for y, w, span in zip(vectors, values, spans, strict=True) if span == lo and w - v <= 1e-3 * w]
        if close:
            others = np.array(close)
            left = part - others.T @ (others @ part)
            if np.linalg.norm(left) < 0.7:       # the same direction once more
                left = _refined(a[lo:hi], b[lo:hi - 1], v, others, len(values))
            left -= others.T @ (others @ left)
            part = left / np.linalg.norm(left)
        y = np.zeros(len(a))
        y[lo:hi] = part
        values, vectors, spans = [*values, v], [*vectors, y], [*spans, lo]
    out = np.array(vectors) @ right.T
    sign = np.sign(out[np.arange(len(out)), np.abs(out).argmax(1)])
    return np.array(values), out * sign[:, None]


# --- the job ----------------------------------------------------------------

def _grid(x: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, x)), "<i8").reshape(len(x), -1) if len(x) else np.zeros((0, 1), np.int64)


def grid_vectors(embeddings: DataFrame, p: WhitenParams) -> DataFrame:
    """(vec_id, x: the entries on the grid as packed 64-bit numbers) of the rows that take part."""
    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return pd.Series([(np.floor(np.asarray(v, float) * p.scale).astype("<i8") + p.shift).tobytes() for v in vectors], dtype=object)

    c = F.col("embedding")
    most = (_LARGEST - p.shift) / p.scale
    fine = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < most))
    rows = embeddings.select("vec_id", c).filter(fine)
    size = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("embedding") == (size.d if size else 0)).select("vec_id", pack("embedding").alias("x"))


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """(n, S): rows and sums by dimension, in whole numbers of any size."""
    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = _grid(pdf.x)
            yield pd.DataFrame({"dim": np.arange(x.shape[1], dtype=np.int32), "n": len(x),
                                "high": (x >> _SPLIT).sum(0), "low": (x & ((1 << _SPLIT) - 1)).sum(0)}) if len(x) else pd.DataFrame({"dim": [], "n": [], "high": [], "low": []})

    got = fit.mapInPandas(partial, "dim int, n long, high long, low long").groupBy("dim").agg(*[F.sum(k).alias(k) for k in ("n", "high", "low")]).orderBy("dim").collect()
    return (got[0].n if got else 0), [(r.high << _SPLIT) + r.low for r in got]


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(float) - rest


def triangle(fit: DataFrame, dims: int, whole: np.ndarray, rest: np.ndarray, p: WhitenParams) -> np.ndarray:
    """R of the QR of the centred fit list: blocks within tasks, then a tree over the tasks."""
    def reduced(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = np.zeros((0, dims))
        for pdf in parts:
            z = _centred(_grid(pdf.x), whole, rest)
            for at in range(0, len(z), p.block_rows):
                r = np.linalg.qr(np.vstack((r, z[at:at + p.block_rows])), mode="r")
        if len(r):
            yield pd.DataFrame({"r": [r.tobytes()]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        rs = [np.frombuffer(r, float).reshape(-1, dims) for r in pdf.sort_values("part").r]
        return pd.DataFrame({"part": [pdf.part.iloc[0] // p.fan_in], "r": [np.linalg.qr(np.vstack(rs), mode="r").tobytes()]})

    level = pin(fit.select("x").mapInPandas(reduced, "r binary").withColumn("part", F.spark_partition_id().cast("long")).select("part", "r"), "whiten-r")
    count = level.agg(F.max("part").alias("m")).first().m
    while count is not None and count > 0:
        last, level = level, pin(level.groupBy(F.floor(F.col("part") / p.fan_in).alias("up")).applyInPandas(merged, "part long, r binary"), "whiten-r")
        unpin(last)
        count //= p.fan_in
    got = level.first()
    r = np.zeros((dims, dims))
    if got:
        top = np.frombuffer(got.r, float).reshape(-1, dims)
        r[:len(top)] = top
    unpin(level)
    return r


def deviations(x: np.ndarray, n: int, whole: list[int], left: list[int]) -> list[int | None]:
    """sum((n * x - S) ** 2) of each row, exactly; None beyond 64 bits."""
    near = x - np.array(whole, np.int64)
    most = int(np.abs(near).max(initial=0)) + 1
    if (n * most) ** 2 * x.shape[1] < 1 << 63:
        d = n * near - np.array(left, np.int64)
        return (d * d).sum(1).tolist()
    out = [sum((n * v - s) ** 2 for v, s in zip(row, left, strict=True)) for row in near.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(embeddings: DataFrame, params: WhitenParams = WhitenParams()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part."""
    p, spark = params, embeddings.sparkSession
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = pin(grid_vectors(embeddings, p), "whiten-rows")
    fit = pin(rows.select("x").distinct(), "whiten-fit")
    n, sums = exact_sums(fit)
    if not n:
        return spark.createDataFrame([], out)
    dims = len(sums)
    whole_, left_ = [s // n for s in sums], [s % n for s in sums]
    whole, rest = np.array(whole_, np.int64), np.array([s / n for s in left_])
    r = triangle(fit, dims, whole, rest, p)
    values, vectors = directions(r, p.components)
    if not len(values):
        return spark.createDataFrame([], out)
    to = (vectors / np.sqrt(values / n)[:, None]).T
    share = values / float((r * r).sum())

    def products(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, j = np.triu_indices(to.shape[1])
        for pdf in parts:
            w = _centred(_grid(pdf.x), whole, rest) @ to if len(pdf) else np.zeros((0, to.shape[1]))
            yield pd.DataFrame({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": (w.T @ w)[i, j]})

    cells = fit.mapInPandas(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    error = cells.agg(F.max(F.abs(F.col("s") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("e")).first().e

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(x: pd.Series) -> pd.DataFrame:
        g = _grid(x)
        w = _centred(g, whole, rest) @ to if len(g) else np.zeros((0, to.shape[1]))
        return pd.DataFrame({"deviation": pd.array(deviations(g, n, whole_, left_), dtype="Int64"), "whitened": list(w)})

    each = rows.select("vec_id", project("x").alias("w")).select("vec_id", F.col("w.deviation").alias("deviation"), F.posexplode("w.whitened").alias("k", "whitened"))
    unpin(fit)
    parts = F.lit(share.tolist())
    return each.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(parts, F.col("k") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
