"""Whitening against dense eigenvectors, exact sums against integers, awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kgspark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, k=4):
    """vec_id -> (deviation, whitened up to signs), explained, n."""
    kept = [(i, v) for i, v in rows if usable(v)]
    width = max(len(v) for _, v in kept)
    x = [(i, [math.floor(256 * c) for c in v] + [0] * (width - len(v))) for i, v in kept]
    fit = [list(t) for t in sorted({tuple(v) for _, v in x})]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([float(Fraction(s, n)) for s in sums])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > values[0] * 1e-12).sum()))
    on = (np.array([v for _, v in x], float) - np.array(sums) / n) @ axes[:, :k] / np.sqrt(values[:k])
    return [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums)), w) for (i, v), w in zip(x, on)], values[:k] / values.sum(), n


def check(found, rows):
    expected, explained, n = brute(rows)
    k = len(explained)
    got = {}
    for r in found:
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert len(found) == k * len(expected)
    for j in range(k):
        mine = sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"], r["whitened"]) for r in found if r["component"] == j + 1)
        signs = [sorted((i is not None, i or 0, d, s * w[j]) for i, d, w in expected) for s in (1, -1)]
        assert min(max(abs(a[3] - b[3]) for a, b in zip(mine, other)) for other in signs) < 1e-7
        assert [a[:3] for a in mine] == [a[:3] for a in signs[0]]
    for r in found:
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 and r["residual"] < 1e-13


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 12)) * np.linspace(1, 2, 12)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(400, None), (401, [1.0, None] * 6), (402, [math.nan] * 12), (403, [math.inf] + [0.0] * 11), (404, []), (405, [0.5, -0.25])]
    return rows + [rows[0]] * 200 + [(None, rows[1][1]), (7, rows[2][1])]


def test_against_dense(spark, vectors):
    table = spark.createDataFrame(vectors, SCHEMA).repartition(5).withColumns({c: F.lit(c) for c in ("id", "x", "n", "vector", "whitened", "a.b")})
    check(whitening.op12_whitening(table).collect(), vectors)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])] * 3, [(1, []), (2, [])]])
def test_tables_without_variance(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    assert whitening.op12_whitening(table).collect() == []
    assert whitening.whiten(table).count() == sum(usable(v) for _, v in rows)


def test_flat_directions_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]
    found = whitening.op12_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in found} == {1}
    check(found, rows)


def test_large_entries_stay_exact(spark):
    rows = [(i, [2.0**40 * i, 3.0 * i * i, -1.0]) for i in range(6)] + [(9, [1e300, 0.0, 0.0])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = {i: d for i, d, _ in brute(rows[:6])[0]}
    assert len(found) == 6 and all(r["deviation"] == (expected[r["id"]] if expected[r["id"]] < 2**63 else None) for r in found)


def test_ties_of_eigenvalues():
    for matrix in (np.eye(6), np.diag([3.0, 3, 3, 3, 3, 1]), np.diag([5.0, 5, 1, 1, 1, 1, 0, 0])):
        values, axes, errors = whitening.jacobi_davidson(lambda q: matrix @ q, len(matrix))
        assert np.allclose(values, sorted(np.diag(matrix), reverse=True)[:4], rtol=1e-13) and np.allclose(axes.T @ axes, np.eye(4), atol=1e-13)
        assert np.abs(matrix @ axes - axes * values).max() < 1e-13 * values[0]


def test_close_eigenvalues_in_many_dimensions():
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    wanted = np.sort(np.concatenate([[1, 1 - 1e-6, 1 - 2e-6, 0.999], rng.uniform(0, 0.99, 296)]))[::-1]
    matrix = q * wanted @ q.T
    matrix = (matrix + matrix.T) / 2
    values, axes, errors = whitening.jacobi_davidson(lambda c: matrix @ c, 300)
    assert np.allclose(values, wanted[:4], rtol=1e-13) and errors.max() < 1e-13
    assert np.abs(matrix @ axes - axes * values).max() < 1e-13


def test_packing_round_trip():
    rng = np.random.default_rng(2)
    rows = np.array([rng.integers(-(2**b), 2**b, 9) for b in (3, 7, 8, 15, 31, 40, 62) for _ in range(4)])
    rows[::3, 5:] = 0
    rows[1] = 0
    back = sorted(tuple(v) for block in whitening.unpacked(whitening.packed(rows), 9) for v in block)
    assert back == sorted(map(tuple, rows))
    assert whitening.packed(np.array([[1, 2, 0]])) == whitening.packed(np.array([[1, 2]]))


def test_blocks_are_bounded():
    made = pa.array([[1.0]] * 50 + [[0.5] * 100] + [None, []] + [[2.0]] * 50, pa.list_(pa.float64()))
    blocks = list(whitening.blocks_of(made, most=200))
    assert max(v.size for _, v in blocks) <= 200 and [i for rows, _ in blocks for i in rows] == [*range(51), *range(52, 103)]
