"""Whitening against numpy on whole tables, exact sums, and the secular equation."""

from fractions import Fraction

import numpy as np
import pytest

from llm.whitening import SCHEMA, Spectrum, Whitening, deviations, rank_one, whiten

INPUT = "vec_id long, embedding array<float>, component int, n long, x string"


def table(spark, vectors, parts=4):
    rows = [(i, v, 7, 8, "y") for i, v in vectors]
    return spark.createDataFrame(rows, INPUT).repartition(parts)


def whole(vectors):
    return np.array([[int(np.floor(np.float64(np.float32(c)) * 1024)) + 100000 for c in v] for v in vectors], dtype=np.int64)


def check(rows, vectors, ids, most=8):
    """Rows against numpy's eigenvectors of the exact covariance."""
    x = whole(vectors)
    n, total = len(x), [int(t) for t in x.sum(axis=0)]
    centred = np.array([[float(Fraction(int(v) * n - t, n)) for v, t in zip(row, total)] for row in x])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(found) == sorted(ids)
    for k in range(1, min(most, x.shape[1]) + 1):
        want = centred @ components[:, k - 1] / np.sqrt(values[k - 1])
        got = np.array([found[i][k].whitened for i in ids])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        assert found[ids[0]][k].explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
    for i, row in zip(ids, x.tolist()):
        assert found[i][1].deviation == sum((n * v - t) ** 2 for v, t in zip(row, total)) == int(found[i][1].deviation_exact)
        assert found[i][1].n == n and found[i][1].identity_error < 1e-8


def test_equals_numpy_over_tasks(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((600, 12)) * np.linspace(0.05, 1, 12) + 3).astype(np.float32)
    vectors[100:300] = vectors[0]  # a third of all rows is one vector
    rows = whiten(table(spark, list(enumerate(vectors.tolist())), 21)).collect()
    assert len(rows) == 600 * 8
    check(rows, vectors, list(range(600)))


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0, 0.5], [0.0, 0.0, 0.0], [-1.0, 0.25, 7.0], [3.5, -2.0, 1.0], [0.125, 4.0, 2.0]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = whiten(table(spark, [*enumerate(good), *((100 + i, v) for i, v in enumerate(bad))])).collect()
    assert len(rows) == 15
    check(rows, good, list(range(5)))


def test_repeated_rows_and_ids_count_each(spark):
    rows = whiten(table(spark, [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (1, [2.0, 5.0]), (None, [2.0, 1.0])])).collect()
    assert len(rows) == 8 and {r.n for r in rows} == {4}
    assert sum(r.vec_id is None for r in rows) == 2
    assert rows[0].identity_error < 1e-12


def test_components_without_variance(spark):
    rows = whiten(table(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)])).collect()
    by = {k: [r for r in rows if r.component == k] for k in (1, 2, 3)}
    assert all(r.whitened is not None and r.explained == pytest.approx(1) for r in by[1])
    assert all(r.whitened is None and r.explained < 1e-12 for k in (2, 3) for r in by[k])
    (one,) = whiten(table(spark, [(1, [4.0])])).collect()
    assert (one.n, one.deviation, one.whitened, one.explained, one.identity_error) == (1, 0, None, None, None)


@pytest.mark.parametrize("vectors", [[], [(1, None), (2, []), (3, [None])]])
def test_tables_without_vectors(spark, vectors):
    found = whiten(table(spark, vectors, 1))
    assert found.collect() == [] and found.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()


def test_fewer_components_and_another_scale(spark):
    rows = whiten(table(spark, [(i, [i * 1.0, (i * i) % 7 * 1.0]) for i in range(9)]), Whitening(components=1, scale=1, shift=0)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 9


def test_deviations_are_exact_at_any_size():
    rng = np.random.default_rng(2)
    for n, spread in ((7, 50), (10**12 + 3, 300), (10**6, 10**14)):
        x = rng.integers(-spread, spread, (20, 5)) + 100000
        total = [int(t) * n // 20 + 3 for t in x.sum(axis=0)]
        assert deviations(x, total, n) == [sum((n * v - t) ** 2 for v, t in zip(row, total)) for row in x.tolist()]


@pytest.mark.parametrize("size", [1, 2, 3, 20])
def test_rank_one_updates_keep_an_exact_decomposition(size):
    rng = np.random.default_rng(size)
    values, vectors, plain = np.zeros(size), np.eye(size), np.zeros((size, size))
    for step in range(200):
        v = rng.integers(-3, 4, size).astype(float) * (step % 5 > 0)
        if step % 7 == 0:
            v[size // 2 :] = 0
        rho = float(rng.integers(0, 4)) * 10.0 ** rng.integers(-6, 6)
        values, vectors = rank_one(values, vectors, v, rho)
        plain += rho * np.outer(v, v)
        scale = max(np.abs(plain).max(), 1e-300)
        assert np.all(np.diff(values) >= 0)
        assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-12
        assert np.abs(vectors * values @ vectors.T - plain).max() < 1e-11 * scale


def test_spectra_merge_like_one():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((60, 6)) + 10
    parts = [Spectrum(6) for _ in range(4)]
    for i, v in enumerate(x):
        parts[i % 3].add(v, 2)  # the last stays empty
    for other in parts[1:]:
        parts[0].merge(other)
    centred = x - x.mean(axis=0)
    found = parts[0].vectors * parts[0].values @ parts[0].vectors.T
    assert parts[0].n == 120 and np.allclose(parts[0].mean, x.mean(axis=0))
    assert np.abs(found - 2 * centred.T @ centred).max() < 1e-10
