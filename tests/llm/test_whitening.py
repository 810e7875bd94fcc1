"""Whitening against NumPy's eigenvectors and exact sums in Python integers."""

import math
import random

import numpy as np
import pytest

from conftest import TESTDATA
from knotwork.llm import whitening
from knotwork.llm.queries import QUERIES


def expected(vectors, components=8):
    """n, deviations, whitened (up to sign), explained: with Python integers and eigh."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    z = [[n * c - s for c, s in zip(v, sums)] for v in x]
    deviation = [sum(c * c for c in v) for v in z]
    centred = np.array(z, float) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, deviation, centred @ found[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_query_against_brute_force(spark):
    folder = str(TESTDATA)
    rows = sorted(spark.read.parquet(f"{folder}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    n, deviation, white, explained = expected([r.embedding for r in rows])
    got = sorted(QUERIES["op13_whitening"](spark, folder).collect(), key=lambda r: (r.vec_id, r.component))
    assert len(got) == 8 * len(rows) and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    table = np.array([r.whitened for r in got]).reshape(-1, 8)
    signs = np.sign((table * white).sum(axis=0))
    assert np.allclose(table, white * signs, atol=1e-8)
    for at, r in enumerate(got):
        assert (r.n, r.deviation, r.component) == (n, deviation[at // 8], at % 8 + 1)
        assert abs(r.explained / explained[at % 8] - 1) < 1e-9
    again = QUERIES["op13_whitening"](spark, folder).repartition(3).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_factor_and_rotations():
    rng = np.random.default_rng(4)
    for width, rank, spread in ((1, 1, 1), (5, 5, 1), (12, 7, 1), (33, 33, 1e6), (64, 64, 1)):
        a = rng.normal(size=(rank, width)) * np.logspace(0, math.log10(spread), rank)[:, None]
        matrix = a.T @ a
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape == (width, rank) and np.allclose(factor @ factor.T, matrix, rtol=1e-9, atol=1e-9 * spread**2)
        norms, columns = whitening.jacobi_columns(factor)
        assert np.allclose(norms, np.linalg.svd(factor, compute_uv=False), rtol=1e-10)
        assert np.abs(columns @ columns.T - np.eye(rank)).max() < 1e-12
        assert np.allclose(matrix @ columns.T, columns.T * norms**2, atol=1e-9 * norms[0]**2)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_products_of_large_numbers_are_exact():
    rng = random.Random(1)
    x = np.array([[rng.randrange(-(1 << 41), 1 << 41) for _ in range(3)] for _ in range(1000)], np.int64)
    high, mixed, low = whitening.halves_product(x)
    exact = x.astype(object).T @ x.astype(object)
    assert ((high.astype(object) << 42) + (mixed.astype(object) << 21) + low.astype(object) == exact).all()


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, "n") for i, v in enumerate(vectors)], "n int, embedding array<double>, row string")


def test_large_and_tiny_entries(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(40, 3)) * [1e6, 1.0, 1e-2]).tolist()
    n, deviation, white, explained = expected(vectors)
    got = sorted(whitening.whiten(rows_of(spark, vectors)).collect(), key=lambda r: (r.row.n, r.component))
    assert [r.deviation for r in got[::3]] == [d if d < 2**63 else None for d in deviation]
    table = np.array([r.whitened for r in got]).reshape(-1, 3)
    signs = np.sign((table * white).sum(axis=0))
    assert np.allclose(table[:, :2], (white * signs)[:, :2], atol=1e-5)
    assert abs(got[0].identity_error) < 1e-4


def test_defined_cases(spark):
    good = np.random.default_rng(1).normal(size=(12, 4)).tolist()
    bad = [None, [], [None, 1.0, 1.0, 1.0], [math.nan] * 4, [math.inf, 0.0, 0.0, 0.0], [1e300] * 4, [1.0, 2.0]]
    got = whitening.whiten(rows_of(spark, good + bad + good[:2])).collect()
    assert {r.row.n for r in got} == {*range(12), 19, 20} and {r.n for r in got} == {14} and len(got) == 14 * 4
    by_row = {(r.row.n, r.component): r.whitened for r in got}
    assert all(by_row[0, c] == by_row[19, c] for c in range(1, 5))
    assert {r.row.row for r in got} == {"n"}
    # One direction only, none at all, a single row, no rows.
    line = whitening.whiten(rows_of(spark, [[float(i), 2.0 * i, 1.0] for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-9
    for few in ([[1.0, 2.0]] * 3, [[1.0, 2.0]], bad[:6], []):
        assert whitening.whiten(rows_of(spark, few)).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(rows_of(spark, [[0.0] * 5000]))
