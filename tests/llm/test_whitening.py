import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import whitening as wh

FOLDER = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def by_vector(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def whole(vectors):
    return {i: [math.floor(64 * float(np.float32(x))) + wh.SHIFT for x in v] for i, v in vectors.items()}


def compare(got, vectors, top=32):
    """Whitened values against numpy's eigenvectors of the exact covariance; signs are free."""
    x = whole(vectors)
    ids, values = list(x), np.array(list(x.values()), object)
    n, s = len(ids), values.sum(axis=0)
    off = n * values - s
    m = (off.T @ off) // n
    e, v = np.linalg.eigh(m.astype(float))
    e, v = e[::-1][:top], v[:, ::-1][:, :top]
    keep = e > 1e-9 * e[0]
    z = off.astype(float) @ v[:, keep] / np.sqrt(e[keep])
    assert set(got) == set(ids)
    ours = np.array([[got[i][c + 1].whitened for c in range(keep.sum())] for i in ids])
    signs = np.sign((ours * z).sum(axis=0))
    assert np.abs(ours * signs - z).max() < 1e-6
    trace = sum(m[i][i] for i in range(len(s)))
    for k, i in enumerate(ids):
        for c, row in got[i].items():
            assert row.n == n and row.deviation == int((off[k] * off[k]).sum())
            assert abs(row.explained - e[c - 1] / float(trace)) < 1e-9
            assert row.identity_error < 1e-9


def test_equals_numpy_on_a_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    compare(by_vector(wh.whiten(table)), {r.vec_id: r.embedding for r in table.collect()})


def test_odd_vectors_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i % 3) * 2, float(i % 5), 1.0], 0) for i in range(40)]
    good += [(40, [3.5], 0), (41, [], 0)]
    bad = [(100, [nan, 1.0, 1.0, 1.0], 0), (101, [inf, 1.0, 1.0, 1.0], 0), (102, None, 0), (103, [None, 1.0, 1.0, 1.0], 0)]
    clash = {c: F.lit("clash") for c in ("y", "z", "n", "component", "at", "whitened", "i", "value")}
    got = by_vector(wh.whiten(spark.createDataFrame(good + bad, VECTORS).withColumns(clash)))
    compare(got, {i: [*v, *[0.0] * (4 - len(v))] for i, v, _ in good})
    # A NULL id and repeated rows take part; four rows of two texts have one component.
    rows = [(None, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (5, [3.0, 1.0], 0), (6, [3.0, 1.0], 0)]
    found = wh.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert [r.component for r in found] == [1] * 4 and {r.n for r in found} == {4}
    assert sorted(round(r.whitened, 9) for r in found) == [-1, -1, 1, 1]
    for empty in ([], [(1, [2.0, 3.0], 0)] * 5, [(1, None, 0)]):
        assert wh.whiten(spark.createDataFrame(empty, VECTORS)).collect() == []


def test_equal_eigenvalues_give_orthonormal_components(spark):
    corners = [(i, [float(2 * (i >> k & 1) - 1) for k in range(4)] + [9.0], 0) for i in range(16)]
    found = by_vector(wh.whiten(spark.createDataFrame(corners, VECTORS)))
    z = np.array([[found[i][c].whitened for c in range(1, 5)] for i in range(16)])
    assert np.abs(z.T @ z / 16 - np.eye(4)).max() < 1e-12 and all(set(f) == {1, 2, 3, 4} for f in found.values())
    assert all(abs(r.explained - 0.25) < 1e-15 for f in found.values() for r in f.values())


def exact_polynomial(m):
    """Faddeev and LeVerrier, in fractions."""
    d, c = len(m), [Fraction(1)]
    a = [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        a = [[sum(m[i][t] * a[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(m[i][t] * a[t][i] for i in range(d) for t in range(d)) / k)
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("seed", range(4))
def test_polynomial_and_roots_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 9, size=(12, 7)).astype(object)
    x[:, 5] = x[:, 4] if seed == 1 else x[:, 5]
    m = (x.T @ x * 10**12).tolist() if seed else np.diag([6, 6, 6, 5, 1, 0, 0]).tolist()
    poly = wh.characteristic(spark, m)
    assert poly == exact_polynomial(m)
    roots = wh.eigenvalues(poly)
    assert sum(k for _, k in roots) == (6 if seed == 1 else 5 if seed == 0 else 7)
    if seed == 0:
        assert [(round(float(r), 12), k) for r, k in roots] == [(6, 3), (5, 1), (1, 1)]
    expected = sorted(np.linalg.eigvalsh(np.array(m, float)), reverse=True)
    flat = [float(r) for r, k in roots for _ in range(k)]
    assert np.allclose(flat, expected[: len(flat)], rtol=1e-9)


def test_close_roots_are_told_apart():
    # Two eigenvalues that agree in 20 digits: (z - a)(z - a - 1) with a = 10^20.
    a = 10**20
    roots = wh.eigenvalues([a * (a + 1), -(2 * a + 1), 1])
    assert [int(round(r)) for r, _ in roots] == [a + 1, a]


def test_hessenberg_survives_zero_pivots():
    m = [[0, 0, 2, 1], [0, 3, 0, 0], [2, 0, 0, 5], [1, 0, 5, 0]]
    for p in wh.primes_beyond(1 << 100):
        assert wh.polynomials(m, [p])[0].tolist() == [c % p for c in exact_polynomial(m)]


def test_large_entries_stay_exact():
    y = np.array([[1 << 40, 3], [-(1 << 41), 7]], np.int64)
    assert wh.products(y).tolist() == [[(1 << 80) + (1 << 82), 3 * (1 << 40) - 7 * (1 << 41)], [3 * (1 << 40) - 7 * (1 << 41), 58]]
