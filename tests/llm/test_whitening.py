"""Spectral divide and conquer and whitening, against numpy's eigenvectors and whole numbers."""

import math

import numpy as np
import pytest

from gleanwork.llm import whitening

COLUMNS = "vec_id long, embedding array<float>, n long, component string"


def spread(size, values, seed=0):
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]
    return basis @ np.diag(values) @ basis.T


@pytest.mark.parametrize(
    "matrix",
    [
        np.eye(1), np.zeros((4, 4)), 2 * np.eye(6), np.diag([5.0, 3, 3, 1, 0]), np.array([[2.0, 1], [1, 2]]),
        spread(40, [1.0] * 10 + [2.0] * 10 + [3.0] * 20), spread(30, 10.0 ** -np.arange(30)),
        spread(25, 1 + 1e-9 * np.arange(25)), spread(100, np.arange(100.0)), spread(33, [0.0] * 30 + [1, 2, 3]),
    ],
)
def test_eigenvectors(matrix):
    values, basis = whitening.eigenvectors(matrix)
    size = max(float(np.linalg.norm(matrix, 2)), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1], atol=1e-13 * size, rtol=0)
    assert np.abs(matrix @ basis - basis * values).max() <= 1e-13 * size
    assert np.abs(basis.T @ basis - np.eye(len(matrix))).max() <= 1e-13


def test_polar_factor():
    a = spread(20, np.append(np.arange(1.0, 11), -np.arange(1.0, 11)))
    u = whitening.polar_factor(a)
    assert np.abs(u @ u.T - np.eye(20)).max() < 1e-12 and np.abs(u.T @ a - (u.T @ a).T).max() < 1e-11


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(4)
    return (draw.standard_normal((200, 40)) @ np.diag(np.linspace(0.3, 3, 40))).astype(np.float32)


def check(frame, wanted):
    whole = np.floor(64 * np.asarray([v for _, v in wanted], float)).astype(np.int64) + 1_000_000
    n, sums = len(whole), whole.sum(axis=0)
    centred = whole - sums / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:32], basis[:, ::-1][:, :32]
    whitened = centred @ basis / np.sqrt(values)
    out = {}
    for r in frame.collect():
        out.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert sum(len(c[1]) for c in out.values()) == n
    signs = {}
    for (vec_id, _), row, exact in zip(wanted, whitened, ((n * whole - sums).astype(object) ** 2).sum(axis=1)):
        assert sorted(out[vec_id]) == list(range(1, len(values) + 1))
        for i, value in enumerate(row):
            for r in out[vec_id][i + 1]:
                if len(out[vec_id][i + 1]) == 1:
                    assert r.deviation == exact and r.n == n
                    signs.setdefault(i, np.sign(r.whitened * value))
                    assert abs(r.whitened * signs[i] - value) < 1e-9
                assert math.isclose(r.explained, values[i] / np.trace(covariance), rel_tol=1e-9)
                assert r.identity_error <= 1e-4


def test_whitening(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(500, None), (501, [None] + rows[0][1][1:]), (502, [math.nan] + rows[0][1][1:]), (None, rows[3][1])]
    odd += [(503, [math.inf] + rows[0][1][1:]), (7, rows[7][1]), (504, rows[1][1])]
    frame = spark.createDataFrame([(*row, 1, "c") for row in rows + odd], COLUMNS).repartition(3)
    out = whitening.whiten(frame)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out, rows + [odd[3], odd[5], odd[6]])


def test_short_vectors_end_in_zeros(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors[:80, :5])] + [(90, [1.0, 2.0]), (91, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check(whitening.whiten(frame), [(i, v + [0.0] * (5 - len(v))) for i, v in rows])


def test_without_variance(spark):
    columns = "vec_id string, embedding array<double>"
    for rows in ([], [("a", None)], [("a", [1.0, 2.0])], [("a", [1.0]), ("b", [1.0])], [("a", [])]):
        assert whitening.whiten(spark.createDataFrame(rows, columns)).count() == 0
    few = whitening.whiten(spark.createDataFrame([("a", [1.0, 2.0, 0.0]), ("b", [2.0, 1.0, 0.5])], columns)).collect()
    assert {r.component for r in few} == {1} and all(abs(abs(r.whitened) - 1) < 1e-9 for r in few)


def test_large_numbers_stay_exact():
    centre = whitening.Centre(10**9, [10**15 + 7, 3 * 10**15 + 1])
    offsets = np.asarray([[1, 2], [40, -30], [3, 0]])
    whole = offsets + centre.floor
    wanted = [sum((10**9 * int(x) - s) ** 2 for x, s in zip(row, [10**15 + 7, 3 * 10**15 + 1])) for row in whole]
    assert centre.deviations(offsets) == [w if w < 2**63 else None for w in wanted]
    with pytest.raises(ValueError):
        import pyarrow as pa

        whitening._whole_numbers(pa.array([[1e300]]))
