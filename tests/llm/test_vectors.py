"""Whitening and nearest neighbours against plain numpy and plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import nearest_neighbours, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label string, component int, qid long, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7, 8, "s") for i, v in rows], SCHEMA)


# ------------------------------------------------------------------ whitening


def test_eigenvectors():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 40):
        x = rng.normal(size=(200, size)) * np.logspace(0, -5, size)
        v = x.T @ x
        values, basis = whitening.jacobi_eigen(v)
        assert (np.diff(values) <= 0).all()
        assert np.allclose(basis.T @ basis, np.eye(size), atol=1e-13)
        assert np.allclose((basis * values) @ basis.T, v, rtol=1e-12, atol=1e-12 * values[0])
    assert np.allclose(whitening.jacobi_eigen(np.zeros((3, 3)))[0], 0)
    assert np.allclose(whitening.jacobi_eigen(np.ones((3, 3)))[0], [3, 0, 0])


def test_small_eigenvalues_are_accurate():
    """A graded matrix: relative accuracy where a method with absolute errors keeps no digit."""
    scale = np.array([1.0, 1e-6, 1e-12])
    v = np.array([[1, 0.5, 0.2], [0.5, 1, 0.3], [0.2, 0.3, 1]]) * scale[:, None] * scale
    product = np.prod(whitening.jacobi_eigen(v)[0])
    exact = (1 + 2 * 0.5 * 0.2 * 0.3 - 0.25 - 0.04 - 0.09) * np.prod(scale) ** 2
    assert product == pytest.approx(exact, rel=1e-9)


def plain_whitening(rows, k=32):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    covariance = y.T @ y / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(k, len(values))
    white = y @ basis[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return [i for i, _ in kept], n, deviation, white, values[:k] / values.sum()


def test_whitening_of_the_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    ids, n, deviation, white, explained = plain_whitening(rows)
    got = queries.op11_whitening(spark, sf_dir).collect()
    assert len(got) == len(ids) * 32 and {r["n"] for r in got} == {n}
    values = {(r["vec_id"], r["component"]): r for r in got}
    assert all(values[i, c + 1]["deviation"] == d for i, d in zip(ids, deviation) for c in range(32))
    found = np.array([[values[i, c + 1]["whitened"] for c in range(32)] for i in ids])
    assert np.allclose(found * np.sign((found * white).sum(0)), white, atol=1e-6)
    assert np.allclose([values[ids[0], c + 1]["explained"] for c in range(32)], explained, rtol=1e-9)
    error = np.abs(np.cov(found.T, bias=True) - np.eye(32)).max()
    assert error < 1e-9 and all(abs(r["identity_error"] - error) < 1e-9 for r in got)


def test_whitening_leaves_unusable_vectors_out(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, [*rows, rows[3], (None, rows[4][1]), *odd])).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == sorted(
        (i is None, i or 0, c) for i in [*range(30), 3, None] for c in (1, 2, 3)
    )
    ids, n, deviation, white, _ = plain_whitening([*rows, rows[3], (None, rows[4][1])])
    assert {r["n"] for r in got} == {32}
    assert {(r["vec_id"], r["deviation"]) for r in got} == set(zip(ids, deviation))


def test_whitening_without_variance(spark):
    for rows in ([(1, [1.0, 2.0])], [(1, [0.5, 0.5])] * 3):
        got = whitening.whiten(frame(spark, rows)).collect()
        assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in got] == [(0.0, 0.0, 0, 0.0)] * (2 * len(rows))
    flat = [(i, [float(i), 1.0]) for i in range(5)]
    got = whitening.whiten(frame(spark, flat)).collect()
    assert all(r["whitened"] == 0 and r["explained"] == 0 for r in got if r["component"] == 2)
    assert all(r["explained"] == 1 and r["identity_error"] < 1e-12 for r in got if r["component"] == 1)
    assert whitening.whiten(frame(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_deviations_of_huge_entries():
    x = np.array([[2**40, 5], [1, 7]], np.int64)
    fit = whitening.Whitening(2, [int(c) for c in x.sum(0)], np.empty(0), 0.0, np.empty((0, 0)))
    assert fit.deviations(x) == [None, None]
    x = np.array([[2**31, 5], [1, 7], [3, 4]], np.int64)
    fit = whitening.Whitening(3, [int(c) for c in x.sum(0)], np.empty(0), 0.0, np.empty((0, 0)))
    assert fit.deviations(x) == [d if d < 2**63 else None for d in (sum((3 * int(c) - int(s)) ** 2 for c, s in zip(v, x.sum(0))) for v in x)]


# --------------------------------------------------------- nearest neighbours


def plain_nearest(rows, asks, k):
    ok = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or not asks(i):
            continue
        scored = []
        for b, (j, c) in enumerate(ok):
            if a != b and len(c) == len(q):
                total = 0.0
                for x, y in zip(q, c):
                    total += x * y
                scored.append((-total, j is None, j or 0))
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()], key=str)


def clustered(seed, n=400, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = [(int(i), [float(v) for v in np.float32(centres[i % 6] * (i % 3 + 1) + rng.normal(size=size) * 0.001)]) for i in rng.permutation(n)]
    copy = rows[0][1]
    rows += [(1000 + i, copy) for i in range(120)] + [(1000, copy), (1000, rows[1][1]), (None, copy), (None, rows[2][1]), (1005, [-v for v in copy])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * size), (2003, [float("nan")] * size), (2004, [1.0, None] * (size // 2)), (2005, [1.0, 2.0]), (2010, [2.0, 1.0]), (2015, [float("inf")] * size)]
    return rows


@pytest.mark.parametrize("block", [64, 4096])
def test_nearest_is_exact(spark, block):
    rows = clustered(5)
    got = nearest_neighbours.nearest_neighbours(frame(spark, rows), F.expr("vec_id % 5 = 0"), k=20, block_queries=block, block_candidates=block)
    assert found(got) == plain_nearest(rows, lambda i: i % 5 == 0, 20)


def test_fewer_than_k_and_nothing(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (3, [0.0, 1.0])]
    got = nearest_neighbours.nearest_neighbours(frame(spark, rows), F.expr("vec_id % 20 = 0"))
    assert found(got) == [(0, 1, 1, 1.0), (0, 2, 3, 0.0)]
    assert nearest_neighbours.nearest_neighbours(frame(spark, rows[:1]), F.expr("vec_id % 20 = 0")).count() == 0
    assert nearest_neighbours.nearest_neighbours(frame(spark, rows[1:]), F.expr("vec_id % 20 = 0")).count() == 0
    assert nearest_neighbours.nearest_neighbours(frame(spark, []), F.expr("vec_id % 20 = 0")).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 64)) * rng.choice([1e-3, 1.0, 30.0], size=(1500, 1))
    q, c = nearest_neighbours.Codes(x[:100]), nearest_neighbours.Codes(x)
    near, error = q.bounds(slice(0, 100), c, slice(0, 1500))
    assert (np.abs(near - x[:100] @ x.T) <= error).all()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, column, score, recomputed = nearest_neighbours.search_tile(x[:100], x, np.arange(1500), 21)
    assert recomputed < 100 * 1500 / 10
    want = np.sort(-(x[:100] @ x.T), axis=1)[:, :21]
    assert np.allclose(-score.reshape(100, 21), want) and (row == np.repeat(np.arange(100), 21)).all()


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e30, 1e30]), (1, [1e30, -1e30]), (2, [3e38, 3e38]), (3, [1e-38, 1e-38]), (4, [1e-45, 0.0]), (20, [-3e38, 3e38])]
    got = nearest_neighbours.nearest_neighbours(frame(spark, rows), F.expr("vec_id % 20 = 0"))
    assert found(got) == plain_nearest(rows, lambda i: i % 20 == 0, 20)
