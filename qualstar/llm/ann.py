"""Approximate nearest neighbours by inner product: inverted lists and an
adaptive scan over the dimensions of rotated vectors.

One coordinate more, sqrt(M^2 - |x|^2) with M the largest norm, turns largest
inner product into smallest distance.  Centroids come from k-means over a
bounded sample (``sample`` rows by id hash); every row is put into its nearest list.
A query probes its nearest lists until they hold ``probe_share`` of all rows and
at least ``least_scan`` rows, so small tables are searched whole.

A list farther from a query than its bound, by the distance of its centroid less
the list's radius, is not probed.  Within a list the vectors are turned by one
random rotation and compared in blocks of columns, a block of queries at a time,
so that a column block read serves all of them.  After each block the distance
so far, scaled up to all dimensions, is tested against the query's bound; a
candidate that exceeds it by more than ``eps`` standard deviations is abandoned
for that query.  While many pairs are left a block is one matrix product, then
the remaining pairs are compared one by one.  The bound is the distance
of the k-th nearest vector of the sample.  Survivors get the exact inner product
of the original vectors in double precision.  The sample's own best are results
too, so a query always has k, or all candidates if there are fewer.

Lists and the queries that probe them are dealt out in a grid of blocks of
bounded size, so a list that holds most of the rows is many small tasks.  Of
rows with the same vector only the k + 1 smallest ids can be among the k
nearest; the others are left out before anything is compared (they are still
queries).  What goes through the driver or is broadcast is the sample, the
centroids and a row per list: all bounded by parameters.

Rows without an id and vectors that are null, zero, hold null or non-finite
components or have not the most frequent number of components take no part.
Rows repeated in id and vector are one candidate and one query; rows of one id
with different vectors are one query together (its nearest are the best of
all its vectors), and none of them is a candidate of it.  Other columns take no
part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin, unpin


@dataclass(frozen=True)
class AnnParams:
    k: int = 20
    query_step: int = 20         # rows whose id is divisible by it are queries
    list_rows: int = 512         # rows per list aimed at
    max_lists: int = 1024
    sample: int = 4096
    rounds: int = 10             # of k-means
    probe_share: float = 0.65
    least_scan: int = 4000
    columns: int = 16            # of a block
    eps: float = 2.1
    block_vectors: int = 8192
    block_queries: int = 2048
    batch_queries: int = 256     # compared with a list at a time
    few: float = 0.03            # share of pairs left from which on they are compared one by one


def _packed(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, vectors)), "<f8").reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v: the components as packed doubles) of the rows that take part, each once."""
    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, "<f8").tobytes() for v in vectors], dtype=object)

    x = F.col("embedding")
    fine = (F.col("vec_id").isNotNull() & x.isNotNull() & F.exists(x, lambda c: c != 0)
            & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x).filter(fine)
    size = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("embedding") == (size.d if size else 0))
    return rows.select("vec_id", pack("embedding").alias("v")).dropDuplicates()


@dataclass
class Lists:
    """What every task needs: rotation, centroids, and the sample with its ids."""
    norm: float
    rotation: np.ndarray
    centroids: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    params: AnnParams

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors with the additional coordinate, rotated."""
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0))
        return (np.hstack((x, more[:, None])) @ self.rotation).astype(np.float32)

    def nearest_lists(self, x: np.ndarray, query: bool) -> np.ndarray:
        y = self.turned(x, query)
        return (self.centroids ** 2).sum(1) - 2 * y @ self.centroids.T


def build_lists(vectors: DataFrame, n: int, p: AnnParams) -> Lists:
    @F.pandas_udf("double")
    def length(v: pd.Series) -> pd.Series:
        return pd.Series(np.linalg.norm(_packed(v), axis=1))

    norm = vectors.select(F.max(length("v")).alias("m")).first().m or 0.0
    got = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(p.sample).toPandas()
    x = _packed(got.v)
    rng = np.random.default_rng(11)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1] + 1,) * 2))[0]
    lists = Lists(float(norm), rotation, np.zeros((1, x.shape[1] + 1), np.float32), x, got.vec_id.to_numpy(np.int64), p)
    k = int(min(p.max_lists, max(1, round(n / p.list_rows)), max(1, len(x))))
    y = lists.turned(x, False)
    c = y[rng.permutation(len(y))[:k]].astype(np.float64)
    for _ in range(p.rounds):
        at = ((c ** 2).sum(1) - 2 * y @ c.T).argmin(1)
        total = np.zeros_like(c)
        np.add.at(total, at, y)
        size = np.bincount(at, minlength=k)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    lists.centroids = c.astype(np.float32)
    return lists


def _dot(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products by row; unlike a matrix product's, equal rows' are equal to the last bit."""
    return (x * q).sum(1)


def column_blocks(y: np.ndarray, columns: int) -> list[np.ndarray]:
    """Blocks of columns, each contiguous, so that a scan reads what it compares only."""
    return [np.ascontiguousarray(y[:, at:at + columns]) for at in range(0, y.shape[1], columns)]


def scan_list(ids: np.ndarray, x: np.ndarray, blocks: list[np.ndarray], qids: np.ndarray, q: np.ndarray, r: np.ndarray, bound: np.ndarray,
              p: AnnParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, candidate number, score) of at most k candidates of one
    list for each query: x and q original, blocks and r rotated; bound: squared
    distances that the k-th nearest does not exceed."""
    dims, seen, k = r.shape[1], 0, 0
    far = np.zeros((len(q), len(x)), np.float32)
    # Rotated distances are rounded to single precision, so the last test has some room.
    room = 1e-5 * (bound + (r * r).sum(1) + max((sum((b * b).sum(1) for b in blocks)).max(initial=0), 0))

    def limit() -> np.ndarray:
        return bound * (1 + p.eps / np.sqrt(seen)) ** 2 * (seen / dims) + room if seen < dims else bound + room

    left = len(q) * len(x)
    while k < len(blocks) and left > p.few * far.size:
        y, part = blocks[k], r[:, seen:seen + blocks[k].shape[1]]
        far += (y * y).sum(1)
        far += (part * part).sum(1)[:, None]
        far -= (2 * part) @ y.T
        seen, k = seen + y.shape[1], k + 1
        alive = far <= limit()[:, None]
        far[~alive] = np.inf
        left = np.count_nonzero(alive)
    i, j = np.nonzero(np.isfinite(far) & (ids != qids[:, None]))
    near = far[i, j]
    for y in blocks[k:]:
        d = y[j] - r[i, seen:seen + y.shape[1]]
        near = near + np.einsum("ij,ij->i", d, d)
        seen += y.shape[1]
        alive = near <= limit()[i]
        i, j, near = i[alive], j[alive], near[alive]
    score = _dot(x[j], q[i])
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i)          # each query's best begin there
    top = np.arange(len(i)) - first < p.k
    return i[top], j[top], score[top]


def _blocks(of: str, of_rows: str, rows_in_block: int) -> Column:
    return F.pmod(F.xxhash64(of), F.greatest(F.lit(1), F.ceil(F.col(of_rows) / rows_in_block))).cast("int")


def _all_blocks(of_rows: str, rows_in_block: int) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.greatest(F.lit(1), F.ceil(F.col(of_rows) / rows_in_block)) - 1).cast("int")))


def search(embeddings: DataFrame, params: AnnParams = AnnParams()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every query row."""
    p, spark = params, embeddings.sparkSession
    all_ = pin(valid_vectors(embeddings), "ann-vectors")
    same = W.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    vectors = pin(all_.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= p.k + 1).drop("n"), "ann-distinct")
    n = vectors.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    shared = spark.sparkContext.broadcast(build_lists(vectors, n, p))

    @F.pandas_udf("list int, far double")
    def placed(v: pd.Series) -> pd.DataFrame:
        L, x = shared.value, _packed(v)
        at = L.nearest_lists(x, False).argmin(1)
        return pd.DataFrame({"list": at.astype(np.int32), "far": np.linalg.norm(L.turned(x, False) - L.centroids[at], axis=1).astype(float)})

    lists = pin(vectors.select("vec_id", "v", placed("v").alias("p")).select("vec_id", "v", "p.*"), "ann-lists")
    known = {r["list"]: r for r in lists.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}   # max_lists rows
    sizes = spark.sparkContext.broadcast(np.array([(known[i].n, known[i].far) if i in known else (0, 0.0) for i in range(p.max_lists)]).T)
    enough = max(p.least_scan, p.probe_share * n)

    @F.pandas_udf("bound double, lists array<int>, ids array<long>, scores array<double>")
    def prepared(qid: pd.Series, v: pd.Series) -> pd.DataFrame:
        """Bound, probed lists and the best of the sample."""
        L, q = shared.value, _packed(v)
        size, radius = sizes.value[:, :len(L.centroids)]
        near = L.nearest_lists(q, True)
        order = near.argsort(1)
        away = np.sqrt(np.maximum(near + (q * q).sum(1)[:, None], 0))     # from the centroids
        rows = []
        for i, x, o, a in zip(qid.to_numpy(), q, order, away, strict=True):
            total = np.cumsum(size[o])
            others = np.flatnonzero(L.sample_ids != i)
            score = _dot(L.sample[others], x)
            top = others[np.lexsort((L.sample_ids[others], -score))[:p.k]]
            best = _dot(L.sample[top], x)
            bound = float(x @ x + L.norm ** 2 - 2 * best[-1]) if len(top) == p.k else np.inf
            lists_ = o[:int(np.searchsorted(total, min(enough, total[-1]))) + 1]
            reach = a[lists_] - radius[lists_] <= np.sqrt(max(bound, 0)) * (1 + 1e-4) + 1e-4 * L.norm
            rows.append((bound, lists_[(size[lists_] > 0) & reach].astype(np.int32), L.sample_ids[top], best))
        return pd.DataFrame(rows, columns=["bound", "lists", "ids", "scores"])

    queries = pin(all_.filter(F.col("vec_id") % p.query_step == 0)
                  .select(F.col("vec_id").alias("query_id"), "v", prepared("vec_id", "v").alias("s")).select("query_id", "v", "s.*"), "ann-queries")
    probes = queries.select("query_id", F.explode("lists").alias("list"))
    grid = F.broadcast(lists.groupBy("list").agg(F.count("*").alias("n_v"))
                       .join(probes.groupBy("list").agg(F.count("*").alias("n_q")), "list"))   # max_lists rows
    left = (lists.drop("far").join(grid, "list").select("list", _blocks("vec_id", "n_v", p.block_vectors).alias("vb"),
                                            _all_blocks("n_q", p.block_queries).alias("qb"), "vec_id", "v"))
    right = (queries.select("query_id", "v", "bound", F.explode("lists").alias("list")).join(grid, "list")
             .select("list", _all_blocks("n_v", p.block_vectors).alias("vb"), _blocks("query_id", "n_q", p.block_queries).alias("qb"),
                     "query_id", "v", "bound"))

    def scan(vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        L = shared.value
        ids, x, q = vs.vec_id.to_numpy(np.int64), _packed(vs.v), _packed(qs.v)
        found = []
        if len(ids) and len(q):
            y, r = column_blocks(L.turned(x, False), p.columns), L.turned(q, True)
            qids, bounds = qs.query_id.to_numpy(np.int64), qs.bound.to_numpy(float)
            for at in range(0, len(q), p.batch_queries):
                own = slice(at, at + p.batch_queries)
                i, j, score = scan_list(ids, x, y, qids[own], q[own], r[own], bounds[own], p)
                found.append(pd.DataFrame({"query_id": qids[own][i], "vec_id": ids[j], "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    key = ["list", "vb", "qb"]
    scanned = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(scan, "query_id long, vec_id long, score double")
    sampled = queries.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("z")).select("query_id", F.col("z.ids").alias("vec_id"), F.col("z.scores").alias("score"))
    found = scanned.unionByName(sampled).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    unpin(vectors)
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= p.k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
