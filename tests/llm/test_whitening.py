"""Whitening: the dense algebra against numpy, the job against brute force, odd tables."""

import math
from collections import defaultdict

import numpy as np
import pytest

from qualstar.llm import whitening
from qualstar.llm.queries import op12_whitening
from qualstar.llm.whitening import WhitenParams, directions

OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def triangles():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    yield "plain", np.linalg.qr(rng.normal(size=(300, 48)), mode="r")
    yield "equal values", np.eye(48) * 3
    yield "clusters", np.linalg.qr(np.diag([5.0] * 10 + [3.0] * 20 + [1.0] * 18) @ turn, mode="r")
    yield "graded", np.linalg.qr(np.diag(10.0 ** -np.linspace(0, 6, 48)) @ turn, mode="r")
    short = np.zeros((48, 48))
    short[:9] = np.linalg.qr(rng.normal(size=(9, 48)), mode="r")
    yield "few rows", short
    yield "rank 1", np.ones((48, 48))
    yield "close pairs", np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1)
    for i in range(60):
        n = int(rng.integers(1, 24))
        yield f"small whole numbers {i}", np.linalg.qr(rng.integers(-2, 3, size=(n, n)).astype(float), mode="r")


def test_directions_are_eigenvectors():
    for name, r in triangles():
        values, y = directions(r, 16)
        want = np.linalg.svd(r, compute_uv=False) ** 2
        want = want[:16][want[:16] > want[0] * 1e-13]
        assert len(values) == len(want), name
        if len(want):
            assert np.allclose(values, want, rtol=1e-10, atol=want[0] * 1e-14), name
            assert np.abs(y @ y.T - np.eye(len(y))).max() < 1e-10, name
            assert np.abs(r.T @ (r @ y.T) - y.T * values).max() < 1e-11 * want[0], name
    assert len(directions(np.zeros((4, 4)), 16)[0]) == 0


def test_dqds_is_accurate_for_small_values():
    a, b = 10.0 ** -np.arange(0, 12, 1.0), 10.0 ** -np.arange(0.5, 11, 1.0)
    got = whitening.dqds(a, b)
    # The product of all singular values is that of the diagonal, to relative accuracy.
    assert math.isclose(np.log(got).sum(), 2 * np.log(a).sum(), abs_tol=1e-12)


def brute(vectors):
    """{row index: (deviation, whitened up to sign)}, n, shares of the rows that take part."""
    x = {i: [math.floor(64 * float(c)) + 1000000 for c in v] for i, v in vectors.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centre = lambda v: np.array([(n * a - s) / n for a, s in zip(v, sums, strict=True)])
    z = np.array([centre(v) for v in fit])
    values, vecs = np.linalg.eigh(z.T @ z / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return ({i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in x.items()}, {i: centre(v) for i, v in x.items()}, n, values, vecs)


def agree(got, vectors, k):
    deviation, centred, n, values, vecs = brute(vectors)
    rows = defaultdict(dict)
    for r in got:
        rows[r.vec_id][r.component] = r
    assert set(rows) == set(vectors) and all(sorted(r) == list(range(1, k + 1)) for r in rows.values())
    signs = {}
    for i, by in rows.items():
        for c, r in by.items():
            want = centred[i] @ vecs[:, c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(want * r.whitened))
            assert abs(abs(want) - abs(r.whitened)) < 1e-7 * max(1, abs(want))
            assert r.n == n and r.deviation == deviation[i]
            assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = op12_whitening(spark, sf)
    assert got.columns == OUT
    agree(got.collect(), {r.vec_id: list(r.embedding) for r in rows}, 16)


def test_many_tasks_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 7
    good = {i: base[i % 300 if i < 600 else 3].tolist() for i in range(1500)}
    bad = [(5000, None), (5001, []), (5002, [None] * 12), (5003, [float("nan")] * 12), (5004, [float("inf")] + [0.0] * 11), (5005, [1.0, 2.0]), (5006, [1e300] + [0.0] * 11)]
    data = [(i, v, 1, "k", 0.5, "x") for i, v in [*good.items(), *bad]]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, n int, x string, w double, dim string").repartition(23)
    for p in (WhitenParams(), WhitenParams(fan_in=2, block_rows=7)):
        agree(whitening.whiten(table, p).collect(), good, 12)


def test_deviations_beyond_the_machine_are_exact():
    whole, left, n = [1000000, -5], [3, 10 ** 9 - 1], 10 ** 9
    x = np.array([[1000001, -5], [1000000, -4], [10 ** 15, 7]])
    assert whitening.deviations(x, n, whole, left) == [(n - 3) ** 2 + (10 ** 9 - 1) ** 2, 9 + 1, None]
    small = np.array([[1000002, -5]])
    assert whitening.deviations(small, 10, whole, [3, 4]) == [(20 - 3) ** 2 + 16]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(9)], [(None, [3.0])]])
def test_without_variance_there_is_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got.columns == OUT and got.count() == 0


def test_fewer_rows_than_dimensions_and_rows_without_an_id(spark):
    rng = np.random.default_rng(2)
    rows = [(i if i else None, rng.normal(size=10).tolist()) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 5 * 4 and sum(r.vec_id is None for r in got) == 4 and max(r.identity_error for r in got) < 1e-10
