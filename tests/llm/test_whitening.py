"""Whitening against numpy's eigenvectors and Python's integers."""

import math

import numpy as np
import pytest

from txlake.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, n int, component string"


def plain(rows, k):
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max(len(v) for _, v in kept)
    x = [[math.floor(1024 * c) + 100_000 for c in v] + [100_000] * (dims - len(v)) for _, v in kept]
    n = len(x)
    s = [sum(r[j] for r in x) for j in range(dims)]
    deviation = [sum((n * r[j] - s[j])**2 for j in range(dims)) for r in x]
    z = np.array([[(n * r[j] - s[j]) / n for j in range(dims)] for r in x])
    v = z.T @ z / n
    value, vector = np.linalg.eigh(v)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    return [i for i, _ in kept], deviation, z, value, vector, np.trace(v)


def check(got, rows, k=8, degenerate=False):
    ids, deviation, z, value, vector, trace = plain(rows, k)
    k = min(k, z.shape[1])
    real = int((value > 1e-12 * max(trace, 1e-300)).sum())
    assert len(got) == len(ids) * k
    by = {(r.vec_id, r.component): r for r in got}
    w = np.array([[by[i, c + 1].whitened if c < real else 0.0 for c in range(real)] for i in ids]) if real else np.zeros((len(ids), 0))
    for i, d in zip(ids, deviation, strict=True):
        for c in range(1, k + 1):
            r = by[i, c]
            assert r.n == len(ids) and r.deviation == (d if d < 1 << 63 else None)
            assert (r.whitened is None) == (c > real)
            assert r.explained == pytest.approx(value[c - 1] / trace, rel=1e-10) if c <= real else r.explained == 0
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8
    assert np.abs(w.T @ w / len(ids) - np.eye(real)).max(initial=0) < 1e-8
    if not degenerate:
        want = z @ vector[:, :real] / np.sqrt(value[:real])
        for c in range(real):
            a, b = w[:, c], want[:, c]
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6


def run(spark, rows, k=8):
    table = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA).repartition(4)
    return whitening.whitened_components(table, k).collect()


@pytest.mark.parametrize("dims", [1, 3, 8, 24])
def test_whitening(spark, dims):
    rng = np.random.default_rng(dims)
    mix = rng.normal(size=(dims, dims))
    rows = [(i, [float(c) for c in rng.normal(size=dims) @ mix + 3]) for i in range(300)]
    odd = [(1000, None), (1001, [float("nan")] * dims), (1002, [None] * dims), (1003, [float("-inf")] * dims), (1004, []), (1005, rows[0][1][:1])]
    check(run(spark, rows + odd), rows + odd)
    check(run(spark, rows, 3), rows, 3)


def test_bunched_eigenvalues(spark):
    # twelve axes of exactly equal variance: no gap to cut in
    rows = [(i, [float(s) if j == i // 2 else 0.0 for j in range(12)]) for i in range(24) for s in [(1, -1)[i % 2]]]
    check(run(spark, rows), rows, degenerate=True)
    # two bunches
    rows += [(100 + i, [float(s) * 7 if j == i // 2 else 0.0 for j in range(12)]) for i in range(6) for s in [(1, -1)[i % 2]]]
    check(run(spark, rows), rows, degenerate=True)


def test_low_rank_and_few_rows(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-3, 4, size=(3, 10))
    rows = [(i, [float(c) for c in rng.integers(-4, 5, 3) @ base]) for i in range(50)]
    check(run(spark, rows), rows)
    for few in (rows[:2], rows[:1], rows[:1] * 1):
        check(run(spark, few), few)
    same = [(i, rows[0][1]) for i in range(5)]
    check(run(spark, same), same)


def test_large_components_and_offsets(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in 1e6 + rng.normal(size=5) * [1, 2, 3, 4, 5]]) for i in range(200)]
    check(run(spark, rows), rows)
    wide = [(i, [float(c) for c in rng.normal(size=5) * 1e7 * [1, 2, 3, 4, 5]]) for i in range(200)]
    got = run(spark, wide)
    check(got, wide)
    assert any(r.deviation is None for r in got)


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None), (2, [float("nan")])], [(1, []), (2, [])]):
        assert run(spark, rows) == []


def test_feast_finds_what_the_inertia_counts(spark):
    rng = np.random.default_rng(9)
    for value in (np.arange(40.0, 0, -1), np.r_[[5.0] * 6, [4.999999] * 5, np.linspace(1, 2, 29)], np.r_[1e6, 1e3, np.full(38, 1e-3)]):
        q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
        v = (q * value) @ q.T
        v = (v + v.T) / 2
        d, e = whitening.tridiagonal(v)
        exact = np.sort(value)
        shifts = rng.uniform(0, exact[-1] * 1.1, 50)
        assert whitening.counts_below(d, e, shifts).tolist() == np.searchsorted(exact, shifts).tolist()
        got, vec = whitening.feast(spark, v, 10)
        assert np.allclose(got, exact[::-1][:10], rtol=0, atol=1e-9 * exact[-1])
        assert np.abs(v @ vec - vec * got).max() < 1e-10 * exact[-1] and np.abs(vec.T @ vec - np.eye(10)).max() < 1e-7
