"""Whitening against numpy's eigenvectors of the covariance, and exact whole numbers."""

import math

import numpy as np
import pytest

from tapwise.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, k=8):
    """By vec_id and component, and the eigenvalues; entries are known to be sound."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums))) for row in x]
    centred = (n * x - sums).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return n, deviation, values[order], centred @ vectors[:, order] / np.sqrt(values[order]), values.sum()


def check(rows, found, k=8):
    n, deviation, values, white, trace = plain(rows, k)
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(found) == k * len(rows) and set(by_id) == {i for i, _ in rows}
    got = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-8)
    assert [by_id[i][1].deviation for i, _ in rows] == deviation
    assert all(r.n == n and r.identity_error < 1e-9 for r in found)
    assert np.allclose([by_id[rows[0][0]][c].explained for c in range(1, k + 1)], values / trace, rtol=1e-10)


def some_vectors(n, d, seed=1, steep=0.8):
    rng = np.random.default_rng(seed)
    mixed = (rng.standard_normal((n, d)) * steep ** np.arange(d)) @ np.linalg.qr(rng.standard_normal((d, d)))[0]
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(mixed * 3 + 1)]


def rows_of(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)


@pytest.mark.parametrize(("n", "d"), [(300, 12), (40, 9), (10, 30)])
def test_components_are_those_of_the_covariance(spark, n, d):
    rows = some_vectors(n, d)
    check(rows, whitening.whiten(rows_of(spark, rows)).collect())


def dense(matrix):
    sweeps = []

    def sweep(w, known):
        sweeps.append(1)
        t = matrix @ w
        return float(t @ t), (matrix @ known).T @ t, matrix.T @ t

    return sweep, sweeps


@pytest.mark.parametrize("kind", ["flat", "equal", "low rank", "steep", "twice", "zero column"])
def test_bidiagonalisation(kind):
    rng = np.random.default_rng(7)
    left, right = np.linalg.qr(rng.standard_normal((500, 60)))[0], np.linalg.qr(rng.standard_normal((60, 60)))[0]
    values = {
        "flat": np.linspace(1.1, 1, 60),
        "equal": np.repeat([3.0, 2.0, 1.0], 20),
        "low rank": np.r_[[5.0, 4.0, 4.0, 1.0], np.zeros(56)],
        "steep": 0.5 ** np.arange(60),
        "twice": np.repeat(0.6 ** np.arange(30), 2),
        "zero column": np.r_[np.linspace(9, 1, 59), 0],
    }[kind] * 1000
    sweep, sweeps = dense((left * values) @ right)
    found, vectors = whitening.leading_components(sweep, 60, 8)
    real = np.sort(values)[::-1][:8]
    real = real[real > 0]
    assert np.allclose(found, real, rtol=1e-11)
    assert np.allclose(vectors.T @ vectors, np.eye(len(real)), atol=1e-12)
    images = (left * values) @ (right @ vectors)
    assert np.allclose(images.T @ images, np.diag(real**2), atol=1e-9 * real[0] ** 2)


def test_steps_end_when_components_have_settled():
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((2000, 400)) * 0.7 ** np.arange(400)
    sweep, sweeps = dense(matrix - matrix.mean(axis=0))
    found, _ = whitening.leading_components(sweep, 400, 8)
    assert np.allclose(found, np.linalg.svd(matrix - matrix.mean(axis=0))[1][:8], rtol=1e-12)
    assert len(sweeps) < 150


def test_odd_vectors(spark):
    """Null, empty, short, huge and non-finite vectors go; repeated rows and null ids count."""
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(200, 10)
    odd = [(900, None), (901, []), (902, [nan] * 10), (903, [inf] + [0.0] * 9), (904, [None] + [1.0] * 9), (905, [1.0] * 4), (906, [1e30] * 10)]
    check(rows, whitening.whiten(rows_of(spark, rows + odd).selectExpr("*", "1 AS x", "2 AS n", "3 AS component")).collect())
    twice = rows + rows + [(None, rows[0][1])]
    found = whitening.whiten(rows_of(spark, twice)).collect()
    assert len(found) == 8 * 401 and {r.n for r in found} == {401}
    assert sum(r.vec_id is None for r in found) == 8


def test_without_variance_there_are_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(i, [0.5, 0.25, 4.0]) for i in range(9)], [(1, None)]):
        found = whitening.whiten(rows_of(spark, rows))
        assert found.columns == [f.split()[0] for f in whitening.SCHEMA.split(", ")] and found.count() == 0
    line = [(i, [float(i), 1.0, -2.0 * i]) for i in range(20)]
    found = whitening.whiten(rows_of(spark, line)).collect()
    assert len(found) == 20 and all(r.explained == pytest.approx(1) for r in found)


def test_deviations_are_exact_and_end_where_a_long_does():
    rng = np.random.default_rng(5)
    for spread in (1000, 2**40, 2**61):
        x = rng.integers(-spread, spread, (50, 6))
        sums = [int(s) for s in x.astype(object).sum(axis=0)]
        want = [min(sum((50 * int(a) - s) ** 2 for a, s in zip(row, sums)), 2**63 - 1) for row in x]
        assert whitening.Centre.of(50, sums).deviations(x) == want


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check(rows, queries.op13_whitening(spark, sf_dir).collect())
