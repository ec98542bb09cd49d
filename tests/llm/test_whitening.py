from fractions import Fraction

import numpy as np
import pytest

from fundtrail.llm import registry, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(x):
    """Eigenvalues (falling) and vectors of the covariance of the distinct rows, by numpy."""
    u = np.unique(x, axis=0)
    e, w = np.linalg.eigh(np.cov(u.T, bias=True).reshape(x.shape[1], x.shape[1]))
    return u, e[::-1], w[:, ::-1]


def check(rows, x, ids, k, tolerance=1e-9):
    u, e, w = plain(x)
    n, mean, total = len(u), u.mean(axis=0), u.sum(axis=0)
    for c in range(k):
        mine = sorted((r["vec_id"], r["whitened"], r["deviation"]) for r in rows if r["component"] == c + 1)
        want = (x - mean) @ w[:, c] / np.sqrt(e[c])
        order = np.argsort(ids, kind="stable")
        got = np.array([v for _, v, _ in mine])
        sign = np.sign((got * want[order]).sum())
        assert [i for i, _, _ in mine] == sorted(ids)
        assert np.abs(got - sign * want[order]).max() < tolerance
        exact = [sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, total, strict=True)) for row in x[order]]
        assert [int(d) for _, _, d in mine] == exact


def frame(spark, ids, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in zip(ids, rows, strict=True)], SCHEMA).repartition(3)


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((300, 9)) * np.arange(1, 10) / 4
    rows[150:200] = rows[3]  # repeats weigh once
    ids = rng.permutation(300).tolist()
    vectors = frame(spark, ids, rows.tolist())
    model = whitening.fit_whitening(vectors)
    assert model.n == 250 and model.identity_error < 1e-9
    got = whitening.whiten(vectors, model).collect()
    assert len(got) == 1200
    check(got, np.floor(rows * 256), ids, 4)
    _, e, _ = plain(np.floor(rows * 256))
    assert np.allclose(model.explained, e[:4] / e.sum(), rtol=1e-9)


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (2, 2), (5, 5), (6, 3), (8, 8)):
        a = rng.integers(-50, 50, (d, rank)).astype(object)
        matrix = a @ a.T * 10**12 + 0
        got = whitening.characteristic_polynomial(spark, matrix)
        # Faddeev-LeVerrier over fractions
        want, m = [1], np.zeros((d, d), object)
        eye = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
        for k in range(1, d + 1):
            m = matrix @ m + want[-1] * eye
            want.append(-sum((matrix @ m)[i, i] for i in range(d)) / k)
        assert got == [int(c) for c in want[::-1]]
        assert got[: d - rank] == [0] * (d - rank)


def test_hessenberg_with_missing_pivots():
    p = 101
    m = np.array([[1, 0, 0, 2], [0, 3, 0, 0], [0, 0, 5, 1], [4, 0, 7, 6]], object)
    h = whitening.hessenberg(m.astype(np.int64), p)
    assert all(h[i, j] == 0 for i in range(4) for j in range(4) if i > j + 1)
    x = 13
    det = round(np.linalg.det((x * np.eye(4) - m.astype(float)))) % p
    assert sum(int(c) * pow(x, k, p) for k, c in enumerate(whitening.polynomial_mod(m, p))) % p == det


def test_roots_are_enclosed():
    roots = [0, 0, 3, 7, 7, 10**20, 10**20 + 1]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = whitening.largest_roots(poly, 7)
    assert len(found) == 5
    for (low, high, shift), r in zip(found, sorted(roots, reverse=True), strict=False):
        assert low < r << shift <= high and (high - low) << whitening.ROOT_BITS <= low


def test_equal_and_close_eigenvalues(spark):
    # the corners of a cube: three equal variances; then one nearly equal
    corners = [[a, b, c, 0.0] for a in (0.0, 1.0) for b in (0.0, 1.0) for c in (0.0, 1.0)]
    model = whitening.fit_whitening(frame(spark, range(8), corners))
    assert model.components.shape == (4, 3)  # the rank allows three
    assert np.allclose(model.components.T @ model.components, np.eye(3), atol=1e-15)
    assert model.identity_error < 1e-12 and np.allclose(model.explained, [1 / 3] * 3)
    near = [[a * 4096, b * 4096 + b / 256, c, 1.0] for a, b, c, _ in corners]
    model = whitening.fit_whitening(frame(spark, range(8), near))
    assert model.identity_error < 1e-9
    assert np.abs(model.components[:2, :2]).round(6).tolist() == [[0, 1], [1, 0]]


def test_large_numbers(spark):
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((60, 3)) * 2**20)
    vectors = frame(spark, range(60), rows.tolist())
    model = whitening.fit_whitening(vectors)
    got = whitening.whiten(vectors, model).collect()
    check(got, rows * 256, list(range(60)), 3, 1e-6)
    with pytest.raises(ValueError):
        whitening.fit_whitening(frame(spark, [1], [[1e9]]))


def test_odd_rows(spark):
    rows = [
        (1, [0.5, 1.0], 1),
        (1, [0.5, 1.0], 1),
        (None, [1.5, 0.0], None),
        (2, None, 1),
        (3, [0.5, None], 1),
        (4, [float("nan"), 1.0], 1),
        (5, [float("-inf"), 1.0], 1),
        (6, [0.25], None),
        (7, [-0.0, 0.3], None),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'c' as id", "'c' as v", "'c' as x", "1 as component", "2 as n", "'z' as _id"
    )
    model = whitening.fit_whitening(vectors)
    got = whitening.whiten(vectors, model).collect()
    assert model.n == 3 and model.identity_error < 1e-12
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got) == sorted(
        (i is None, i or 0, c) for i in (1, 1, None, 6, 7) for c in (1, 2)
    )
    for r in got:
        assert (r["whitened"] is None) == (r["deviation"] is None) == (r["vec_id"] == 6)
    for part in (vectors.limit(0), vectors.where("vec_id = 2"), vectors.where("vec_id = 1")):
        model = whitening.fit_whitening(part)
        assert whitening.whiten(part, model).collect() == []
    assert whitening.fit_whitening(frame(spark, [1, 2], [[], []])) is None


def test_registered_query(spark):
    rows = registry.op13_embedding_whitening(spark, SF_SMALL).collect()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    x = np.floor(np.stack(table["embedding"].to_numpy()).astype(np.float64) * 256)
    check(rows, x, table["vec_id"].tolist(), 4)
    u, e, _ = plain(x)
    assert {r["n"] for r in rows} == {len(u)}
    assert all(abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-9 for r in rows)
    assert max(r["identity_error"] for r in rows) < 1e-9


def test_registered_query_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op12_ball_codes", "op13_embedding_whitening"):
        assert registry.queries()[name](spark, str(tmp_path)).collect() == []
